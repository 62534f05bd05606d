"""Multiple-choice answers: items, accuracy and the stability report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from termloom.functions import grading
from termloom.schemas import CHOICE_REPORT

NO_SUBJECT = "(no subject)"


def choice_items(
    source: DataFrame, choices: tuple[str, ...] = ("A", "B", "C", "D"), answer_base: int = 0
) -> DataFrame:
    """Source rows with ``choices`` packed and ``answer`` as an index, plus ``prompt``.

    An answer that cannot be read becomes NULL and is dropped by ``usable_items``; a letter after
    the last choice counts on (``E`` is 4) and is never right.
    """
    numeric = dict(source.dtypes)["answer"] != "string"
    packed = grading.pack_choices(*(F.col(f"`{c}`") for c in choices))
    return (
        source.withColumn("choices", packed)
        .drop(*choices)
        .withColumn(
            "answer", grading.normalize_answer(F.col("answer"), numeric, answer_base).cast("int")
        )
        .withColumn("prompt", grading.choice_prompt(F.col("question"), F.col("choices")))
    )


def usable_items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("answer").isNotNull())


def count_rejected(items: DataFrame) -> DataFrame:
    """Items without a readable answer, by subject."""
    return (
        items.groupBy("subject")
        .agg(F.count_if(F.col("answer").isNull()).alias("rejected"))
        .filter(F.col("rejected") > 0)
    )


def with_choice(responses: DataFrame) -> DataFrame:
    """Adds the chosen index as ``predicted`` and whether it is ``correct``."""
    return responses.withColumn(
        "predicted", grading.extract_choice(F.col("response"))
    ).withColumn("correct", F.coalesce(F.col("predicted") == F.col("answer"), F.lit(False)))


def _share(correct: Column, total: Column) -> Column:
    """Accuracy, 0 when there is nothing to answer."""
    return F.coalesce(F.try_divide(correct.cast("double"), total), F.lit(0.0))


def _totals() -> list[Column]:
    return [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("correct", "total")]


def by_subject(rows: DataFrame) -> DataFrame:
    """Correct and total per subject: the one pass over the rows."""
    return rows.groupBy("subject").agg(
        F.count_if("correct").alias("correct"), F.count("*").alias("total")
    )


def accuracy(rows: DataFrame) -> DataFrame:
    """Accuracy per subject and overall; ``level`` tells the rows apart.

    The overall row is added up from the subject rows, so input rows are not doubled as a rollup
    over them would do, and it is there without any input as well.
    """
    subjects = by_subject(rows)
    overall = subjects.agg(*_totals()).withColumn("subject", F.lit(None).cast("string"))

    def line(of: DataFrame, level: str) -> DataFrame:
        share = _share(F.col("correct"), F.col("total")).alias("accuracy")
        return of.select(F.lit(level).alias("level"), "subject", share, "correct", "total")

    return line(subjects, "subject").unionAll(line(overall, "overall"))


def correct_incorrect(rows: DataFrame) -> DataFrame:
    """Right and wrong answers per subject and overall."""
    return accuracy(rows).select(
        "level", "subject", "correct", (F.col("total") - F.col("correct")).alias("incorrect")
    )


def _summary(rows: DataFrame) -> DataFrame:
    """One row: accuracy, correct, total, by_subject. The map has one entry per subject.

    Rows without a subject stand under ``NO_SUBJECT``, as a map has no NULL key.
    """
    share = _share(F.col("correct"), F.col("total")).alias("accuracy")
    name = F.coalesce("subject", F.lit(NO_SUBJECT)).alias("key")
    entry = F.struct(name, F.struct(share, "correct", "total").alias("value"))
    return (
        by_subject(rows)
        .agg(
            *_totals(),
            F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("by_subject"),
        )
        .select(share, "correct", "total", "by_subject")
    )


def choice_report(
    tuned: DataFrame,
    base: DataFrame | None = None,
    run_name: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """One row in the shape of ``schemas.CHOICE_REPORT`` from ``with_choice`` rows.

    With answers of a base model the drop from it is judged as well.
    """
    scored = _summary(tuned).select(
        F.struct("accuracy", "correct", "total", "by_subject").alias("finetuned"),
        F.lit(run_name).cast("string").alias("run_name"),
        F.lit(timestamp).cast("string").alias("timestamp"),
    )
    enough = grading.at_least(F.col("finetuned.accuracy"), grading.MIN_CHOICE_ACCURACY)
    if base is None:
        passed = F.struct(
            F.lit(None).cast("boolean").alias("drop_acceptable"), enough.alias("min_accuracy_met")
        )
        return (
            scored.withColumn("base", F.lit(None).cast(CHOICE_REPORT["base"].dataType))
            .withColumn("performance_drop", F.lit(None).cast("double"))
            .withColumn("passed", passed)
            .withColumn("overall_passed", F.col("passed.min_accuracy_met"))
        )
    reference = _summary(base).select(F.struct("accuracy", "by_subject").alias("base"))
    before, after = F.col("base.accuracy"), F.col("finetuned.accuracy")
    passed = F.struct(
        grading.drop_within(before, after, grading.MAX_DROP_FROM_BASE).alias("drop_acceptable"),
        enough.alias("min_accuracy_met"),
    )
    return (
        scored.withColumn("base", reference.scalar())
        .withColumn("performance_drop", before - after)
        .withColumn("passed", passed)
        .withColumn(
            "overall_passed",
            grading.all_passed(F.col("passed"), ["drop_acceptable", "min_accuracy_met"]),
        )
    )


def choice_details(rows: DataFrame, index: str = "row_index") -> DataFrame:
    """One line per item."""
    return rows.select(
        F.col(index).alias("index"),
        "question",
        "choices",
        F.col("answer").alias("ground_truth_idx"),
        grading.choice_label(F.col("answer"), F.col("answer")).alias("ground_truth"),
        F.col("predicted").alias("prediction_idx"),
        grading.choice_label(F.col("predicted")).alias("prediction"),
        "response",
        "correct",
        "subject",
    )
