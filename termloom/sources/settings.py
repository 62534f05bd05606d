"""Run settings as an append-only table of ``(run, key, value, ts)``."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.schemas import SETTINGS


def append_settings(
    spark: SparkSession, path: str, run: str, settings: Mapping[str, object], ts: datetime
) -> None:
    """Settings of one run; keys not named keep their earlier values."""
    rows = [(run, key, None if value is None else str(value), ts) for key, value in settings.items()]
    spark.createDataFrame(rows, SETTINGS).coalesce(1).write.mode("append").parquet(path)


def latest_config(log: DataFrame, order: Column | str = "ts") -> DataFrame:
    """The latest value of every key of every run. Writes are combined map-side."""
    order = F.col(order) if isinstance(order, str) else order
    return log.groupBy("run", "key").agg(F.max_by("value", order).alias("value"))


def setting(config: DataFrame, run: str, key: str, default: object) -> DataFrame:
    """One row with the value, or the default and ``defaulted`` set where the key is absent."""
    return (
        config.filter((F.col("run") == run) & (F.col("key") == key))
        .agg(F.max("value").alias("value"))
        .select(
            F.coalesce("value", F.lit(str(default))).alias("value"),
            F.col("value").isNull().alias("defaulted"),
        )
    )
