"""Putting vocabulary files together and removing repeated rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from termloom.functions.hashing import row_key
from termloom.functions.validity import is_valid, with_vocab_columns
from termloom.schemas import REQUIRED_COLUMNS, VOCAB_COLUMNS, VOCAB_HEADERS


def rename_vocab(df: DataFrame, headers: Mapping[str, str] = VOCAB_HEADERS) -> DataFrame:
    """Table names for the known headers; other columns stay, absent ones are no error."""
    return df.withColumnsRenamed(dict(headers))


def union_all_by_name(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column absent from a table is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def require_fields(df: DataFrame) -> DataFrame:
    keep = [is_valid(F.col(name)) for name in REQUIRED_COLUMNS]
    return df.filter(reduce(lambda a, b: a & b, keep))


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds ``row_key``, a digest of all columns, the vocabulary columns first.

    Digests cost a pass over the texts, so a key that is there already is kept.
    """
    if "row_key" in df.columns:
        return df
    rows = with_vocab_columns(df)
    names = VOCAB_COLUMNS + [name for name in rows.columns if name not in VOCAB_COLUMNS]
    return rows.withColumn("row_key", row_key([F.col(f"`{name}`") for name in names]))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each identical row, NULL equal to NULL.

    Grouping by the columns themselves keeps this a hash aggregate whose map side already
    collapses copies, so a row repeated in a third of the input sends one record per task.
    """
    return df.distinct()


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows and surplus rows. Only a digest per row is shuffled, and it is combined map-side."""
    copies = df.select(row_key([F.col(f"`{c}`") for c in df.columns]).alias("row_key"))
    return (
        copies.groupBy("row_key")
        .agg(F.count("*").alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("entries"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        )
    )
