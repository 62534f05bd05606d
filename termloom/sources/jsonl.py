"""JSON lines: chats, evaluation rows and anything else row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from termloom.operators.sampling import with_sample_id
from termloom.schemas import CHAT, EVAL


def _strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One ``messages`` list per line; a malformed line fails the job."""
    return _strict(spark, path, CHAT)


def read_eval_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``question`` and ``ground_truth`` per line."""
    return _strict(spark, path, EVAL)


def read_eval_samples(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation rows with a unique ``sample_id``: the digest of the row and its number among equal rows."""
    return with_sample_id(read_eval_jsonl(spark, path))


def json_lines(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """Each row as one JSON text in column ``value``, non-ASCII and column order kept."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct("*"), options).alias("value"))


def write_jsonl(
    df: DataFrame, path: str, keep_nulls: bool = True, mode: str = "errorifexists"
) -> None:
    json_lines(df, keep_nulls).write.mode(mode).text(path)
