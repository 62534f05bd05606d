"""A stored index of draws: counts from which every cut, split and position of a table follows.

A draw is a hash of (seed, key, salt). The index holds the keys, and for each registered (seed, salt) the number of rows
per leading digits with the rows before them. It is written once, next to the table. A cut then reads the
counts and, in one scan of the keys, the draws that share its leading digits; a position needs no scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from termloom.functions.hashing import draw
from termloom.operators.ordering import STEP_DIGITS


@dataclass(frozen=True)
class RankIndex:
    """``counts`` (seed, salt, head, rows, before) and ``keys``, a table of the key alone."""

    counts: DataFrame
    keys: DataFrame
    key: str

    def of(self, seed: int, salt: str) -> DataFrame:
        return self.counts.filter((F.col("seed") == seed) & (F.col("salt") == salt)).select("head", "rows", "before")

    def cut(self, seed: int, salt: str, size: Callable[[Column], Column]) -> Column:
        """The draw of rank ``size(number of rows)``; NULL for size 0 and for an empty table."""
        heads = self.of(seed, salt)
        total = F.sum("rows").over(Window.partitionBy())
        wanted = F.least(size(total).cast("bigint"), total)
        at = (
            heads.withColumn("wanted", wanted)
            .filter("before < wanted and before + rows >= wanted")
            .select(F.struct("head", (F.col("wanted") - F.col("before")).alias("nth")).alias("at"))
            .scalar()
        )
        drawn = self.keys.select(draw(seed, F.col(self.key), F.lit(salt)).alias("drawn"))
        inside = drawn.filter(F.col("drawn").startswith(at["head"]))
        order = Window.orderBy("drawn")
        placed = inside.select("drawn", F.row_number().over(order).alias("nth"), F.lead("drawn").over(order).alias("next"))
        repeated = F.raise_error("the keys of a sample must not repeat").cast("string")
        # A cut through equal draws would not give the exact size.
        once = F.when(F.col("drawn") == F.col("next"), repeated).otherwise(F.col("drawn"))
        return placed.filter(F.col("nth") == at["nth"]).select(once.alias("cut")).scalar()

    def position(self, df: DataFrame, seed: int, salt: str, name: str = "row_index") -> DataFrame:
        """0-based position of every row in the order of its draws, dense over the indexed table."""
        headed = df.withColumn("_drawn", draw(seed, F.col(self.key), F.lit(salt)))
        headed = headed.withColumn("_head", F.substring("_drawn", 1, STEP_DIGITS))
        # At most 65,536 offsets.
        offsets = F.broadcast(self.of(seed, salt).select(F.col("head").alias("_head"), F.col("before").alias("_before")))
        within = Window.partitionBy("_head").orderBy("_drawn")
        return (
            headed.withColumn("_rank", F.row_number().over(within))
            .join(offsets, "_head")
            .select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_before") + F.col("_rank") - 1).alias(name))
        )


def build_rank_index(df: DataFrame, key: str, folder: str, draws: Sequence[tuple[int, str]], mode: str = "errorifexists") -> RankIndex:
    """Write the index of ``df`` for some (seed, salt): one pass over df for the keys, one over the keys."""
    spark = df.sparkSession
    df.select(key).write.mode(mode).parquet(f"{folder}/keys")
    keys = spark.read.schema(df.select(key).schema).parquet(f"{folder}/keys")
    drawn = [
        F.struct(F.lit(seed).alias("seed"), F.lit(salt).alias("salt"), F.substring(draw(seed, F.col(key), F.lit(salt)), 1, STEP_DIGITS).alias("head"))
        for seed, salt in draws
    ]
    counted = keys.select(F.inline(F.array(*drawn))).groupBy("seed", "salt", "head").agg(F.count("*").alias("rows"))
    running = Window.partitionBy("seed", "salt").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    counted.withColumn("before", F.coalesce(F.sum("rows").over(running), F.lit(0))).coalesce(1).write.mode(mode).parquet(f"{folder}/counts")
    return read_rank_index(spark, folder, key)


def read_rank_index(spark: SparkSession, folder: str, key: str) -> RankIndex:
    counts = spark.read.schema("seed int, salt string, head string, rows bigint, before bigint").parquet(f"{folder}/counts")
    return RankIndex(counts, spark.read.parquet(f"{folder}/keys"), key)
