"""Committed runs: the tables of a run become readable together, by one manifest row, or not at all.

A run's tables go to a folder of their own attempt, which no reader looks at. When all are written, one row
that names them is appended to the manifest: a single file, which Spark commits as a whole. A write
that breaks leaves files nobody reads, and the former attempt of the run stays the valid one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MANIFEST = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("tables", T.MapType(T.StringType(), T.StringType())),
        T.StructField("timestamp", T.StringType()),
    ]
)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """All committed attempts; none where nothing was committed yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The valid attempt of every run: the highest version, the attempt's name among equals."""
    rows = manifest(spark, folder)
    order = F.struct("version", "attempt")
    return rows.groupBy("run").agg(F.max_by(F.struct("*"), order).alias("row")).select("row.*")


def start_attempt(folder: str, run: str) -> str:
    """A new folder name for the tables of one attempt."""
    return f"{folder}/data/{run}/{uuid.uuid4().hex}"


def commit_run(
    spark: SparkSession, folder: str, run: str, attempt: str, tables: Mapping[str, str], timestamp: str | None = None
) -> None:
    """Make the written tables (name to format) of an attempt the valid ones of the run."""
    before = manifest(spark, folder).filter(F.col("run") == run).agg(F.max("version")).first()[0]
    row = (run, 0 if before is None else before + 1, attempt, dict(tables), timestamp)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def write_run(
    folder: str, run: str, tables: Mapping[str, DataFrame], timestamp: str | None = None, reports: tuple[str, ...] = ()
) -> None:
    """Write tables as Parquet, those in ``reports`` as one JSON document, then commit them together."""
    spark = next(iter(tables.values())).sparkSession
    attempt = start_attempt(folder, run)
    for name, table in tables.items():
        writer = table.coalesce(1).write.format("json") if name in reports else table.write.format("parquet")
        writer.save(f"{attempt}/{name}")
    commit_run(spark, folder, run, attempt, {n: "json" if n in reports else "parquet" for n in tables}, timestamp)


def read_run(
    spark: SparkSession, folder: str, run: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table of the run's valid attempt; an unknown run or table is an error that names it."""
    row = latest(spark, folder).filter(F.col("run") == run).first()
    if row is None or name not in row.tables:
        raise LookupError(f"run {run!r} in {folder} has no committed table {name!r}")
    reader = spark.read.format(row.tables[name])
    if row.tables[name] == "json":
        reader = reader.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).load(f"{row.attempt}/{name}")
