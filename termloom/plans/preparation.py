"""Preparation end to end: stored pairs to lengths, settings, an evaluation file, a split and a step plan.

Everything a training run reads is written under one attempt and committed together. The draws' index is made once and gives
the hold-out and the split; both are comparisons per row, so no join takes rows apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions import lengths as length_functions
from termloom.functions.chat import render_pair
from termloom.operators import profile, sampling
from termloom.operators.combine import count_duplicates, drop_duplicates, rename_vocab, with_row_key
from termloom.operators.pairs import count_by_type, count_skipped
from termloom.operators.rank_index import RankIndex, build_rank_index, read_rank_index
from termloom.plans.training import shuffled_chats, training_pairs
from termloom.sources.runs import commit_run, latest, read_run, start_attempt
from termloom.sources.settings import append_settings

EVALUATION, TRAINING, VALIDATION, LENGTHS, OVER_LIMIT, STEPS, INDEX = (
    "evaluation",
    "training",
    "validation",
    "lengths",
    "over_limit",
    "steps",
    "index",
)


@dataclass
class PreparedRun:
    """Tables of a committed preparation; ``validation`` is None without a split."""

    max_seq_length: int
    lengths: DataFrame | None
    over_limit: DataFrame | None
    evaluation: DataFrame
    training: DataFrame
    validation: DataFrame | None
    steps: DataFrame


def run_combination(vocab: DataFrame, folder: str, run: str, timestamp: str | None = None, seed: int = sampling.SAMPLE_SEED) -> DataFrame:
    """Vocabulary to stored pairs and shuffled chats, with the counts of the job: entries, duplicates, skipped rows,
    pairs and pairs by type; gives the counts as (count, type, value) rows."""
    spark = vocab.sparkSession
    attempt = start_attempt(folder, run)
    rows = rename_vocab(vocab)
    training_pairs(rows, seed).write.parquet(f"{attempt}/pairs")
    pairs = spark.read.parquet(f"{attempt}/pairs")
    build_rank_index(pairs, "sample_id", f"{attempt}/{INDEX}", sampling.DRAWS)
    shuffled_chats(pairs, seed).select(F.to_json(F.struct("messages")).alias("value")).write.text(f"{attempt}/chats")

    def line(df: DataFrame, *names: str) -> DataFrame:
        entries = [F.struct(F.lit(n).alias("count"), F.lit(None).cast("int").alias("type"), F.col(n).cast("bigint").alias("value")) for n in names]
        return df.select(F.inline(F.array(*entries)))

    counts = (
        line(count_duplicates(rows), "entries", "duplicates")
        .unionAll(line(count_skipped(drop_duplicates(with_row_key(rows))), "skipped", "pairs"))
        .unionAll(count_by_type(pairs).select(F.lit("pairs of type").alias("count"), "type", F.col("samples").alias("value")))
    )
    counts.coalesce(1).write.parquet(f"{attempt}/counts")
    formats = {"pairs": "parquet", "chats": "json", "counts": "parquet"}
    commit_run(spark, folder, run, attempt, formats, timestamp)
    return read_run(spark, folder, run, "counts")


def combined_index(spark: SparkSession, folder: str, run: str) -> RankIndex:
    """The index of the draws that `run_combination` left beside the pairs."""
    row = latest(spark, folder).filter(F.col("run") == run).first()
    return read_rank_index(spark, f"{row.attempt}/{INDEX}", "sample_id")


def run_preparation(
    pairs: DataFrame,
    folder: str,
    run: str,
    measure: Callable[[Column], Column] = length_functions.word_length,
    test_ratio: float = sampling.TEST_RATIO,
    eval_split: float = sampling.EVAL_SPLIT,
    max_seq_length: int | None = None,
    skip_analysis: bool = False,
    mode: str = "disjoint",
    seed: int = sampling.SAMPLE_SEED,
    index: RankIndex | None = None,
    timestamp: datetime | None = None,
    settings: str | None = None,
) -> PreparedRun:
    """Stored pairs (sample_id, question, response, ...) to what a training run reads.

    Lengths are measured once and stored; statistics, the advised length and the share over it follow from their
    histogram. ``mode='reference'`` trains on held-out rows as well. The validation part is cut from what is
    trained on. Settings found here are appended to the table ``settings`` where one is named.
    """
    if mode not in ("disjoint", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = pairs.sparkSession
    attempt = start_attempt(folder, run)
    formats = {EVALUATION: "json", TRAINING: "parquet", STEPS: "parquet"}

    def kept(df: DataFrame, name: str, few: bool = False) -> DataFrame:
        (df.coalesce(1) if few else df).write.parquet(f"{attempt}/{name}")
        formats[name] = "parquet"
        return spark.read.schema(df.schema).parquet(f"{attempt}/{name}")

    limit = max_seq_length or length_functions.MAX_SEQUENCE
    if not skip_analysis:
        text = render_pair(F.col("question"), F.col("response"))
        histogram = profile.length_histogram(pairs.select(measure(text).alias("length")))
        measured = kept(histogram, LENGTHS, few=True)
        stats = profile.stats_of_histogram(measured).first()
        limit = max_seq_length or stats["recommended_max_seq_length"] or limit
        report = profile.over_limit_of_histogram(measured, F.lit(limit))
        kept(report.withColumn("max_seq_length", F.lit(limit)), OVER_LIMIT, few=True)

    if index is None:
        index = build_rank_index(pairs, "sample_id", f"{attempt}/{INDEX}", sampling.DRAWS)
    marked = sampling.mark_fraction(pairs, "sample_id", test_ratio, seed, index)
    held = marked.filter("held").select("sample_id", "question", F.col("response").alias("ground_truth"))
    held.write.option("ignoreNullFields", "false").json(f"{attempt}/{EVALUATION}")

    trained = marked if mode == "reference" else marked.filter("not held")
    rows = trained.select("sample_id", render_pair(F.col("question"), F.col("response")).alias("text"))
    if eval_split:
        # The index covers all pairs; what is trained on may be fewer, so the split counts its own rows.
        rows = kept(rows, "texts")
        train, validation = sampling.train_eval_split(rows, "sample_id", eval_split)
        kept(validation, VALIDATION)
    else:
        train = rows
    stored = kept(train, TRAINING)
    kept(profile.step_plan(stored, evaluated=bool(eval_split)), STEPS, few=True)
    commit_run(spark, folder, run, attempt, formats, None if timestamp is None else timestamp.isoformat())
    if settings is not None:
        append_settings(spark, settings, run, {"max_seq_length": limit, "run_name": run}, timestamp or datetime(1970, 1, 1))
    return read_preparation(spark, folder, run, limit)


def read_preparation(spark: SparkSession, folder: str, run: str, max_seq_length: int) -> PreparedRun:
    def table(name: str, needed: bool = True) -> DataFrame | None:
        try:
            return read_run(spark, folder, run, name, "sample_id string, question string, ground_truth string" if name == EVALUATION else None)
        except LookupError:
            if needed:
                raise
            return None

    return PreparedRun(
        max_seq_length,
        table(LENGTHS, False),
        table(OVER_LIMIT, False),
        table(EVALUATION),
        table(TRAINING),
        table(VALIDATION, False),
        table(STEPS),
    )
