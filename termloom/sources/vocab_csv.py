"""The combined vocabulary as CSV. Between stages Parquet is the better choice: CSV with line
breaks inside values cannot be split, so a file is read by one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from termloom.functions.validity import NA_TOKENS, na_to_null
from termloom.schemas import VOCAB

_KEEP_TEXT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_vocab_csv(
    spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS, multi_line: bool = True
) -> DataFrame:
    """Every field as text; the usual spellings of a missing value become NULL."""
    rows = spark.read.schema(VOCAB).options(**_KEEP_TEXT, multiLine=multi_line).csv(path)
    return na_to_null(rows, list(na_tokens))


def write_vocab_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**_KEEP_TEXT).csv(path)
