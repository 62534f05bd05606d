"""Multiple-choice benchmark stored as Parquet in ``subject=...`` folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from termloom.operators.choice import choice_items, count_rejected, usable_items
from termloom.operators.sampling import (
    SAMPLE_SEED,
    SAMPLES_PER_SUBJECT,
    requested_minus_found,
    stratified_sample,
    with_sample_id,
)

ITEMS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("question", "A", "B", "C", "D", "answer")]
)

# Subjects asked for by default.
DEFAULT_SUBJECTS = ["Korean-History", "Criminal-Law", "Law", "Economics", "Psychology"]


def read_subjects(
    spark: SparkSession, path: str, subjects: Sequence[str] = tuple(DEFAULT_SUBJECTS)
) -> DataFrame:
    """Items of the requested subjects; the filter prunes folders before any file is opened."""
    return spark.read.parquet(path).filter(F.col("subject").isin(list(subjects)))


def missing_subjects(
    items: DataFrame, subjects: Sequence[str] = tuple(DEFAULT_SUBJECTS)
) -> DataFrame:
    """Requested subjects of which nothing was found: a warning, not an error."""
    spark = items.sparkSession
    requested = spark.createDataFrame([(s,) for s in subjects], "subject string")
    return requested_minus_found(requested, items, "subject")


@dataclass
class LoadedItems:
    """Sampled choice items, and what kept others out: unreadable subjects, unreadable answers."""

    items: DataFrame
    warnings: DataFrame
    rejected: DataFrame


def load_subjects(
    spark: SparkSession, path: str, subjects: Sequence[str] = tuple(DEFAULT_SUBJECTS), schema: T.StructType = ITEMS
) -> tuple[DataFrame, DataFrame]:
    """Rows of the requested subjects that can be read, and ``(subject, reason)`` for what cannot.

    A missing folder or a broken file costs its own rows only. Files are listed without being opened; those of which
    no row arrives are named. Folders of other subjects are pruned.
    """
    wanted = spark.createDataFrame([(s,) for s in dict.fromkeys(subjects)], "subject string")
    full = T.StructType([*schema.fields, T.StructField("subject", T.StringType())])
    asked = F.col("subject").isin(list(subjects))
    tolerant = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    try:
        items = tolerant.schema(full).parquet(path).filter(asked)
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full), wanted.withColumn("reason", F.lit("no folder"))
    if "subject" not in listed.columns:
        listed = listed.withColumn("subject", F.lit(None).cast("string"))
    files = listed.select("subject", F.element_at(F.split("path", "/"), -1).alias("file")).filter(asked)
    read = items.select("subject", F.col("_metadata.file_name").alias("file")).distinct()
    silent = files.join(read, ["subject", "file"], "left_anti")
    warnings = wanted.join(files, "subject", "left_anti").withColumn("reason", F.lit("no folder")).unionAll(
        silent.select("subject", F.concat(F.lit("no row in "), "file"))
    )
    return items, warnings


def load_choice_items(
    spark: SparkSession,
    path: str,
    subjects: Sequence[str] = tuple(DEFAULT_SUBJECTS),
    per_subject: int = SAMPLES_PER_SUBJECT,
    answer_base: int = 0,
    seed: int = SAMPLE_SEED,
) -> LoadedItems:
    """Up to ``per_subject`` keyed items of each subject that can be read, ready to be asked.

    Items are sampled first, as they are stored; those whose answer cannot be read are then left out and counted.
    """
    rows, warnings = load_subjects(spark, path, subjects)
    sampled = stratified_sample(with_sample_id(rows), "subject", "sample_id", per_subject, seed)
    items = choice_items(sampled, answer_base=answer_base)
    return LoadedItems(usable_items(items), warnings, count_rejected(items))
