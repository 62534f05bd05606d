"""Comparing two models or two variants of one model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termloom.functions import grading

# Metric of a comparison, where the two reports hold it, and the name of its flag.
RECALL_METRICS = {
    "test1_bertscore_f1": "bertscore.f1_mean",
    "test1_headword_recall": "headword_recall.accuracy",
}
CHOICE_METRICS = {"test2_accuracy": "finetuned.accuracy"}
FLAGS = {
    "test1_bertscore_f1": "test1_bertscore",
    "test1_headword_recall": "test1_headword",
    "test2_accuracy": "test2_accuracy",
}


def _metrics(report: DataFrame, fields: dict[str, str], variant: str) -> DataFrame:
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("metric"), F.col(path).cast("double").alias("value"))
            for name, path in fields.items()
        )
    )
    return report.select(F.lit(variant).alias("variant"), F.inline(entries))


def variant_metrics(recall: DataFrame, choice: DataFrame, variant: str) -> DataFrame:
    """The compared metrics of one variant as ``(variant, metric, value)`` rows."""
    return _metrics(recall, RECALL_METRICS, variant).unionAll(
        _metrics(choice, CHOICE_METRICS, variant)
    )


def compare_variants(
    metrics: DataFrame,
    first: str,
    second: str,
    limit: float = grading.MAX_DROP_BETWEEN_VARIANTS,
) -> DataFrame:
    """Absolute drop of every metric from one variant to another, judged against the limit.

    Takes ``(variant, metric, value)`` rows. Both values of a metric meet in one grouped pass. A
    metric without a value on either side stays and does not pass; two values of one variant are
    an error.
    """
    value = F.col("value")

    def only(variant: str):
        mine = F.when(F.col("variant") == variant, value)
        several = F.raise_error(f"more than one value of a metric for {variant}").cast("double")
        return F.when(F.count(mine) > 1, several).otherwise(F.max(mine))

    return (
        metrics.filter(F.col("variant").isin(first, second))
        .groupBy("metric")
        .agg(only(first).alias("first_value"), only(second).alias("second_value"))
        .withColumn("drop", F.col("first_value") - F.col("second_value"))
        .withColumn("passed", F.coalesce(F.col("drop") <= F.lit(limit), F.lit(False)))
    )


def comparison_report(
    comparison: DataFrame,
    first: str,
    second: str,
    run_name: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """One nested row from ``compare_variants`` over the three metrics; all three must pass."""
    names = [*RECALL_METRICS, *CHOICE_METRICS]

    def pick(column: str, alias: dict[str, str]):
        return F.struct(
            *(
                F.max(F.when(F.col("metric") == name, F.col(column))).alias(alias[name])
                for name in names
            )
        )

    same = {name: name for name in names}
    passes = [F.coalesce(F.max(F.when(F.col("metric") == n, F.col("passed"))), F.lit(False)) for n in names]
    return comparison.agg(
        pick("first_value", same).alias(first),
        pick("second_value", same).alias(second),
        pick("drop", same).alias("performance_drop"),
        F.struct(*(p.alias(FLAGS[n]) for p, n in zip(passes, names, strict=True))).alias("passed"),
        (passes[0] & passes[1] & passes[2]).alias("overall_passed"),
    ).select(
        "*",
        F.lit(run_name).cast("string").alias("run_name"),
        F.lit(timestamp).cast("string").alias("timestamp"),
    )


def compare_base(
    rows: DataFrame,
    base: str,
    tuned: str,
    limit: float = grading.MAX_DROP_FROM_BASE,
) -> DataFrame:
    """Accuracy of two models on the same items, from ``(model, correct)`` rows, in one pass."""
    model, correct = F.col("model"), F.col("correct")

    def share(name: str):
        return F.coalesce(
            F.try_divide(
                F.count_if(correct & (model == name)).cast("double"), F.count_if(model == name)
            ),
            F.lit(0.0),
        )

    return (
        rows.agg(share(base).alias("base_accuracy"), share(tuned).alias("tuned_accuracy"))
        .withColumn("performance_drop", F.col("base_accuracy") - F.col("tuned_accuracy"))
        .withColumn("drop_acceptable", F.col("performance_drop") <= F.lit(limit))
        .withColumn(
            "min_accuracy_met",
            grading.at_least(F.col("tuned_accuracy"), grading.MIN_CHOICE_ACCURACY),
        )
        .withColumn("overall_passed", F.col("drop_acceptable") & F.col("min_accuracy_met"))
    )


def unshared_samples(
    rows: DataFrame, first: str, second: str, key: str = "sample_id"
) -> DataFrame:
    """Samples judged for one of two variants only: a comparison over them would be skewed."""
    seen = (
        rows.filter(F.col("variant").isin(first, second))
        .groupBy(key)
        .agg(
            F.max(F.col("variant") == first).alias("in_first"),
            F.max(F.col("variant") == second).alias("in_second"),
        )
    )
    return seen.agg(
        F.count_if(F.col("in_first") & ~F.col("in_second")).alias("only_first"),
        F.count_if(F.col("in_second") & ~F.col("in_first")).alias("only_second"),
    )
