"""Metric reports and per-sample details, one folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from termloom.sources.jsonl import write_jsonl


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report is one row, so one JSON document is written."""
    report.coalesce(1).write.mode(mode).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_details(details: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Detail rows as JSON lines, nulls written out."""
    write_jsonl(details, path, keep_nulls=True, mode=mode)


def write_by_run(df: DataFrame, path: str, run_name: str, mode: str = "append") -> None:
    """Rows under ``run_name=...``, next to those of other runs."""
    df.withColumn("run_name", F.lit(run_name)).write.mode(mode).partitionBy("run_name").parquet(
        path
    )
