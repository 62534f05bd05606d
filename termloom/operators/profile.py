"""Length and score statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from termloom.functions.lengths import over_limit, recommend_length

PERCENTILES = (0.5, 0.95, 0.99)
HISTOGRAM_BINS = 20
# Fixed value: the saving interval without an evaluation part.
SAVE_STEPS = 500
EVALS_PER_EPOCH = 10


def length_histogram(lengths: DataFrame, column: str = "length") -> DataFrame:
    """Rows per distinct length. Lengths are few, so everything below works on a small table.

    A NULL length counts no samples; filtering it out would measure every text twice.
    """
    return lengths.groupBy(F.col(column).cast("bigint").alias("length")).agg(
        F.count(column).alias("samples")
    )


def length_stats(lengths: DataFrame, column: str = "length") -> DataFrame:
    """One row: min, max, mean, median, p95, p99, number of samples and recommended length.

    Percentiles interpolate linearly and are exact. They are taken over the histogram, so no task
    receives more than one counter per distinct length.
    """
    return stats_of_histogram(length_histogram(lengths, column))


def stats_of_histogram(counted: DataFrame) -> DataFrame:
    """``length_stats`` of a ``length_histogram``."""
    length, samples = F.col("length"), F.col("samples")
    percentiles = F.percentile(length, F.array(*(F.lit(p) for p in PERCENTILES)), samples)
    return (
        counted
        .agg(
            F.min(length).alias("min"),
            F.max(length).alias("max"),
            F.try_divide(F.sum(length * samples).cast("double"), F.sum(samples)).alias("mean"),
            percentiles.alias("_percentiles"),
            F.coalesce(F.sum(samples), F.lit(0)).alias("num_samples"),
        )
        .select(
            "min",
            "max",
            "mean",
            *(
                F.get("_percentiles", F.lit(i)).alias(name)
                for i, name in enumerate(("median", "p95", "p99"))
            ),
            "num_samples",
        )
        .withColumn("recommended_max_seq_length", recommend_length(F.col("p99")))
    )


def over_limit_share(lengths: DataFrame, limit: Column, column: str = "length") -> DataFrame:
    """Samples above the limit, their number and percentage; zero when none is."""
    return over_limit_of_histogram(length_histogram(lengths, column), limit)


def over_limit_of_histogram(counted: DataFrame, limit: Column) -> DataFrame:
    """``over_limit_share`` of a ``length_histogram``."""
    return (
        counted
        .agg(
            F.coalesce(
                F.sum(F.when(over_limit(F.col("length"), limit), F.col("samples"))), F.lit(0)
            ).alias("over_limit"),
            F.coalesce(F.sum("samples"), F.lit(0)).alias("num_samples"),
        )
        .withColumn(
            "over_limit_percent",
            F.coalesce(
                F.try_divide(F.col("over_limit") * F.lit(100.0), F.col("num_samples")), F.lit(0.0)
            ),
        )
    )


def score_summary(scores: DataFrame, column: str = "score") -> DataFrame:
    """Mean and population standard deviation."""
    return scores.agg(
        F.avg(column).alias("f1_mean"),
        F.stddev_pop(column).alias("f1_std"),
        F.count(column).alias("num_samples"),
    )


def histogram(scores: DataFrame, column: str = "score", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts of equal-width bins between the extremes; the last bin is closed.

    Where all scores are equal the range is widened by a half on either side. Positions are
    checked against the bin edges, so a score on an edge goes where the edges say, whatever the
    division rounds to. Counting is one conditional count per bin: a single row per task.
    """
    score = F.col(column)
    present = scores.select(score.cast("double").alias(column)).filter(score.isNotNull())
    bounds = present.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    equal = F.col("lo") == F.col("hi")
    at = bounds.select(
        F.struct(
            F.when(equal, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(equal, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    ).scalar()
    lo, hi = at["lo"], at["hi"]

    def edge(i: Column) -> Column:
        return F.when(i == bins, hi).otherwise(lo + i * ((hi - lo) / bins))

    guess = F.least(F.floor((score - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    placed = present.withColumn("_guess", guess).withColumn(
        "_bin",
        F.when(score < edge(F.col("_guess")), F.col("_guess") - 1)
        .when(
            (score >= edge(F.col("_guess") + 1)) & (F.col("_guess") < bins - 1),
            F.col("_guess") + 1,
        )
        .otherwise(F.col("_guess")),
    )
    counts = placed.agg(*(F.count_if(F.col("_bin") == i).alias(f"_{i}") for i in range(bins)))
    rows = counts.select(
        F.inline(
            F.array(
                *(F.struct(F.lit(i).alias("bin"), F.col(f"_{i}").alias("n")) for i in range(bins))
            )
        )
    )
    return rows.select(
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        "n",
    )


def step_plan(
    train: DataFrame, batch_size: int = 16, grad_accum: int = 4, evaluated: bool = True
) -> DataFrame:
    """Optimiser steps per epoch, and the interval of evaluation and saving.

    ``train`` holds the rows of the training part. Without an evaluation part there is no
    evaluation, and saving goes by a fixed interval.
    """
    steps = F.expr(f"num_samples div {batch_size * grad_accum}")
    interval = F.greatest(F.lit(1), F.expr(f"steps_per_epoch div {EVALS_PER_EPOCH}"))
    return (
        train.agg(F.count("*").alias("num_samples"))
        .withColumn("steps_per_epoch", steps)
        .withColumn("eval_steps", interval if evaluated else F.lit(None).cast("bigint"))
        .withColumn("save_steps", interval if evaluated else F.lit(SAVE_STEPS).cast("bigint"))
    )
