"""Evaluation jobs end to end: cap, ask, score, judge, commit; then compare two variants by their stored reports.

Answers are written once and read back, as report, details and scores are jobs of their own. A run's answers, details
and report are committed together, so a comparison reads whole runs only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions.chat import render_prompt
from termloom.operators import choice, compare, inference, sampling
from termloom.operators.semantic import ENCODER_BATCH, Encode, semantic_scores
from termloom.plans.training import compare_reports, evaluate_choice, evaluate_recall
from termloom.schemas import CHOICE_REPORT, RECALL_REPORT, comparison_schema
from termloom.sources.runs import commit_run, read_run, start_attempt

REPORT, DETAILS, ANSWERS, BASE_ANSWERS = "report", "details", "answers", "base_answers"
FORMATS = {REPORT: "json", DETAILS: "json", ANSWERS: "parquet"}


def _asked(
    rows: DataFrame, load_model: Callable[[], inference.Predict], prompt: Column, output: str, settings: inference.Generation, tasks: int | None
) -> DataFrame:
    return inference.predict_batches(
        rows.withColumn("_prompt", prompt), load_model, "_prompt", output, settings.batch_size, settings.max_new_tokens, tasks
    ).drop("_prompt")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_recall(
    samples: DataFrame,
    load_model: Callable[[], inference.Predict],
    load_encoder: Callable[[], Encode],
    folder: str,
    run: str,
    timestamp: str | None = None,
    max_samples: int | None = None,
    settings: inference.Generation = inference.RECALL,
    encoder_batch: int = ENCODER_BATCH,
    tasks: int | None = None,
) -> DataFrame:
    """Knowledge recall of a model over (sample_id, question, ground_truth); the committed report is read back.

    The encoder gets the stored answers, so it runs without the model in memory and a lost task asks
    the model for nothing again.
    """
    spark = samples.sparkSession
    attempt = start_attempt(folder, run)
    rows = sampling.cap_rows(samples, "sample_id", max_samples)
    answered = _written(_asked(rows, load_model, render_prompt(F.col("question")), "prediction", settings, tasks), f"{attempt}/asked")
    scored = _written(semantic_scores(answered, load_encoder, batch_size=encoder_batch, tasks=tasks), f"{attempt}/{ANSWERS}")
    return _judged(spark, evaluate_recall(scored, run, timestamp), FORMATS, folder, run, attempt, timestamp, RECALL_REPORT)


def run_choice(
    items: DataFrame,
    load_model: Callable[[], inference.Predict],
    folder: str,
    run: str,
    timestamp: str | None = None,
    load_base: Callable[[], inference.Predict] | None = None,
    max_samples: int | None = None,
    settings: inference.Generation = inference.CHOICE,
    tasks: int | None = None,
) -> DataFrame:
    """Multiple choice over ``choice.choice_items`` rows, with the drop from a base model where one is given.

    Items without a readable answer are not asked; ``choice.count_rejected`` counts them.
    """
    spark = items.sparkSession
    attempt = start_attempt(folder, run)
    rows = sampling.cap_rows(choice.usable_items(items), "sample_id", max_samples)

    def answers(model, name: str) -> DataFrame:
        asked = _asked(rows, model, render_prompt(F.col("prompt")), "response", settings, tasks)
        return _written(asked, f"{attempt}/{name}")

    tuned = answers(load_model, ANSWERS)
    base = None if load_base is None else answers(load_base, BASE_ANSWERS)
    formats = FORMATS | ({} if base is None else {BASE_ANSWERS: "parquet"})
    return _judged(spark, evaluate_choice(tuned, base, run, timestamp), formats, folder, run, attempt, timestamp, CHOICE_REPORT)


def _judged(spark, found, formats, folder, run, attempt, timestamp, schema) -> DataFrame:
    report, details = found
    details.write.option("ignoreNullFields", "false").json(f"{attempt}/{DETAILS}")
    report.coalesce(1).write.option("ignoreNullFields", "false").json(f"{attempt}/{REPORT}")
    commit_run(spark, folder, run, attempt, formats, timestamp)
    return read_run(spark, folder, run, REPORT, schema)


def unshared_between(spark: SparkSession, folder: str, runs: tuple[str, str]) -> DataFrame:
    """Samples that only one of two runs was judged on: over such runs, a drop may be one of the samples."""
    first, second = (
        read_run(spark, folder, run, ANSWERS).select(F.lit(run).alias("variant"), "sample_id") for run in runs
    )
    return compare.unshared_samples(first.unionAll(second), *runs)


def run_comparison(
    spark: SparkSession,
    folder: str,
    first: tuple[str, str],
    second: tuple[str, str],
    run: str,
    names: tuple[str, str] = ("fp16", "gguf"),
    timestamp: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Comparison of two variants from four committed reports; the committed result is read back.

    ``first`` and ``second`` name the (recall, choice) runs of a variant. With ``strict``, runs over
    different samples are an error.
    """

    def reports(pair: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
        return read_run(spark, folder, pair[0], REPORT, RECALL_REPORT), read_run(spark, folder, pair[1], REPORT, CHOICE_REPORT)

    if strict:
        for pair in zip(first, second, strict=True):
            lone = unshared_between(spark, folder, pair).first()
            if lone.only_first or lone.only_second:
                raise ValueError(f"{pair[0]} and {pair[1]}: {lone.only_first} and {lone.only_second} samples of their own")
    compared = compare_reports(reports(first), reports(second), names, run, timestamp)
    attempt = start_attempt(folder, run)
    compared.coalesce(1).write.option("ignoreNullFields", "false").json(f"{attempt}/{REPORT}")
    commit_run(spark, folder, run, attempt, {REPORT: "json"}, timestamp)
    return read_run(spark, folder, run, REPORT, comparison_schema(*names))
