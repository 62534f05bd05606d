"""Intermediate tables in the shared checkpoint folder, and state kept by a Python worker."""

from __future__ import annotations

import contextlib
import gc
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The column by which `placed` stores its rows.
PART = "part_"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a scratch folder only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = worker_state("scratch", lambda: tempfile.mkdtemp(prefix="shared-"))
    return folder.rstrip("/")


def stored(df: DataFrame, *by: str, compression: str | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder, in folders by the columns named, and read it back.

    Cuts the lineage: a lost executor later costs a reread, not a recomputation.
    """
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names that are none of the columns."""
    out = []
    for name in names:
        while name in columns:
            name += "_"
        out.append(name)
    return out


def keyed(df: DataFrame, name: str = "row_", compression: str | None = None) -> DataFrame:
    """df with a key of each row that is stored, so that ids may repeat or be NULL; no column may have its name."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), compression=compression)


def placed(df: DataFrame, name: str = "row_") -> DataFrame:
    """`keyed`, with a column `part_` by which the rows are stored in buckets, so that `at_place` need not move them.

    All rows of a task are one part, so every task writes one file.
    """
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    rows = df.withColumn(name, F.monotonically_increasing_id()).withColumn(PART, part_of(name))
    label = f"placed_{uuid.uuid4().hex}"
    rows.write.bucketBy(shuffle_partitions(spark), PART).option("compression", "zstd").option("path", path).saveAsTable(label)
    out = spark.table(label)
    spark.sql(f"DROP TABLE {label}")  # its files stay, as the table is external
    return out


def part_of(name: str) -> Column:
    """The part of a row key that `placed` gave: the task that wrote the row."""
    return F.shiftright(name, 33)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def in_place(spark: SparkSession):
    """While it holds, a join by part and key takes both sides as they lie where they are dealt by part; restores the setting."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def at_place(docs: DataFrame, few: DataFrame, key: str, collected: Column, how: str = "inner") -> DataFrame:
    """docs joined by `key` to what is collected of each key's rows of `few`.

    Rows that `placed` stored stay where they are while `in_place` holds, and only `few` is shuffled; its
    `key` must be of docs.
    """
    if PART not in docs.columns:
        return docs.join(few.groupBy(key).agg(collected), key, how)
    # Dealt as the buckets are, which the grouping and the join keep.
    few = few.withColumn(PART, part_of(key)).repartition(shuffle_partitions(docs.sparkSession), PART)
    return docs.join(few.groupBy(PART, key).agg(collected).hint("shuffle_hash"), [PART, key], how)


def sampled(share: float, seed: int, *keys: str) -> Column:
    """Whether a row is among a share of all, by a hash of its keys; shares of any size hold, above 1 all rows."""
    drawn = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed)), 1).cast("double")
    return drawn < F.lit(min(share, 2.0) * 2.0**63)


def spread(df: DataFrame) -> DataFrame:
    """At least as many partitions as the cluster has cores, so that small inputs use all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)


def worker_state(key: str, make):
    """A value made once per Python worker process, whatever number of tasks it runs."""
    held = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    if not hasattr(held, key):
        setattr(held, key, make())
    return getattr(held, key)


def release() -> None:
    """Drop what former stages keep in this Python worker, and hand unused memory back to the system."""
    held = sys.modules.get("_worker_state")
    if held and any(not name.startswith("__") for name in vars(held)):
        for name in [name for name in vars(held) if not name.startswith("__")]:
            delattr(held, name)
        gc.collect()
        pa.default_memory_pool().release_unused()
