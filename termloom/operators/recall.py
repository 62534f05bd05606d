"""Knowledge recall: semantic score, headword and abbreviation of free-text answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from termloom.functions import grading


def align_predictions(predictions: DataFrame, truth: DataFrame, key: str = "sample_id") -> DataFrame:
    """Predictions with their ground truth, one to one by key; a repeated key is an error."""

    def once(rows: DataFrame) -> DataFrame:
        # The window needs the partitioning of the join, so it adds no exchange.
        copies = F.count("*").over(Window.partitionBy(key))
        single = F.when(F.col("_copies") == 1, True).otherwise(F.raise_error(f"repeated {key}").cast("boolean"))
        return rows.filter(F.col(key).isNotNull()).withColumn("_copies", copies).filter(single).drop("_copies")

    return once(predictions).join(once(truth), key, "inner")


def unmatched_predictions(
    predictions: DataFrame, truth: DataFrame, key: str = "sample_id"
) -> DataFrame:
    """How many rows of either side have no partner."""
    left, right = predictions.select(key), truth.select(key)
    lone = left.join(right, key, "left_anti").select(F.lit("prediction").alias("side")).unionAll(
        right.join(left, key, "left_anti").select(F.lit("truth").alias("side"))
    )
    return lone.agg(
        F.count_if(F.col("side") == "prediction").alias("predictions_without_truth"),
        F.count_if(F.col("side") == "truth").alias("truths_without_prediction"),
    )


def judged(aligned: DataFrame) -> DataFrame:
    """Adds ``headword``, ``headword_hit``, ``abbreviation`` and ``abbreviation_hit``.

    The hit columns are NULL where the truth has nothing to look for.
    """
    prediction = F.coalesce(F.col("prediction"), F.lit(""))
    return (
        aligned.withColumn("headword", grading.extract_headword(F.col("ground_truth")))
        .withColumn("abbreviation", grading.extract_abbreviation(F.col("ground_truth")))
        .withColumn("headword_hit", grading.contains_headword(prediction, F.col("headword")))
        .withColumn(
            "abbreviation_hit", grading.contains_abbreviation(prediction, F.col("abbreviation"))
        )
    )


def _share(hits: Column, total: Column) -> Column:
    return F.try_divide(hits.cast("double"), total)


def headword_accuracy(mode: str = "lenient") -> Column:
    """Aggregate struct over ``judged`` rows.

    ``lenient`` counts an answer without a headword as right; ``strict`` leaves it out and gives
    0.0 when nothing is left.
    """
    hits, named = F.count_if("headword_hit"), F.count("headword")
    if mode == "lenient":
        correct = hits + F.count_if(F.col("headword").isNull())
        total = F.count("*")
        accuracy = _share(correct, total)
    elif mode == "strict":
        correct, total = hits, named
        accuracy = F.coalesce(_share(correct, total), F.lit(0.0))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.struct(
        accuracy.alias("accuracy"), correct.alias("correct"), total.alias("total")
    )


def abbreviation_accuracy() -> Column:
    """Aggregate struct over rows that have an abbreviation; accuracy NULL when none has."""
    hits, total = F.count_if("abbreviation_hit"), F.count("abbreviation")
    return F.struct(
        _share(hits, total).alias("accuracy"),
        F.when(total > 0, hits).alias("correct"),
        total.alias("total"),
    )


def scored_counts() -> list[Column]:
    """Aggregates: rows with and without a semantic score."""
    return [F.count("score").alias("num_scored"), F.count_if(F.col("score").isNull()).alias("num_unscored")]


def recall_report(
    rows: DataFrame, run_name: str | None = None, timestamp: str | None = None
) -> DataFrame:
    """One row in the shape of ``schemas.RECALL_REPORT`` from ``judged`` rows with a ``score``.

    The semantic gate fails while any row has no score; the report tells how many.
    """
    metrics = rows.agg(
        *scored_counts(),
        F.struct(
            F.avg("score").alias("f1_mean"), F.stddev_pop("score").alias("f1_std")
        ).alias("bertscore"),
        headword_accuracy("lenient").alias("headword_recall"),
        abbreviation_accuracy().alias("abbreviation_match"),
        F.count("*").alias("num_samples"),
    )
    passed = F.struct(
        (
            grading.at_least(F.col("bertscore.f1_mean"), grading.MIN_SEMANTIC_F1)
            & (F.col("num_unscored") == 0)
        ).alias("bertscore"),
        grading.at_least(F.col("headword_recall.accuracy"), grading.MIN_HEADWORD_RECALL).alias(
            "headword"
        ),
    )
    return metrics.withColumn("passed", passed).select(
        "bertscore",
        "headword_recall",
        "abbreviation_match",
        "passed",
        "num_samples",
        F.lit(run_name).cast("string").alias("run_name"),
        F.lit(timestamp).cast("string").alias("timestamp"),
        grading.all_passed(F.col("passed"), ["bertscore", "headword"]).alias("overall_passed"),
        "num_scored",
        "num_unscored",
    )


def validation_report(rows: DataFrame) -> DataFrame:
    """Metrics taken during training: the strict headword rule."""
    return rows.agg(
        F.avg("score").alias("bertscore_f1"),
        F.stddev_pop("score").alias("bertscore_std"),
        headword_accuracy("strict")["accuracy"].alias("headword_recall"),
        F.count("*").alias("num_samples"),
        *scored_counts(),
    )


def recall_details(rows: DataFrame, index: str = "row_index") -> DataFrame:
    """One line per sample; a missing headword shows as NULL and right."""
    return rows.select(
        F.col(index).alias("index"),
        "question",
        "prediction",
        "ground_truth",
        F.col("score").alias("bertscore_f1"),
        "headword",
        F.coalesce("headword_hit", F.lit(True)).alias("headword_correct"),
    )


def headword_counts(rows: DataFrame) -> DataFrame:
    """Right and wrong headwords under the lenient rule."""
    wrong = F.count_if(~F.coalesce(F.col("headword_hit"), F.lit(True)))
    return rows.agg((F.count("*") - wrong).alias("correct"), wrong.alias("incorrect"))
