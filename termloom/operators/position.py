"""Rows of two stored tables paired by their place, as two lists are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def with_position(stored: DataFrame, name: str = "position") -> DataFrame:
    """0-based place of each row of stored Parquet files, the files in the order of their names.

    A reader knows the row's place in its file; the rows of the files before it are counted per file, so the
    only window runs over one row a file. ``stored`` is the table as read, as places belong to files.
    """
    rows = stored.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    running = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        rows.groupBy("_file")
        .agg(F.count("*").alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    )
    placed = rows.join(files, "_file").withColumn(name, F.col("_before") + F.col("_place"))
    return placed.select(*(F.col(f"`{c}`") for c in stored.columns), name)


def align_by_position(predictions: DataFrame, truth: DataFrame, name: str = "position") -> DataFrame:
    """Stored predictions next to the stored truths of the same place; the shorter table ends the pairing.

    Columns of both must differ. Files may be cut differently: places count over the whole table.
    """
    both = set(predictions.columns) & set(truth.columns)
    if both:
        raise ValueError(f"columns of both tables: {sorted(both)}")
    return with_position(predictions, name).join(with_position(truth, name), name)
