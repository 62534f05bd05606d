"""The corpus pipeline: quality, near copies, benchmark text, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and calls one operator
of the llm subpackage; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import decontaminate, ngram_jaccard, packing, surrogates, weak_quality
from termloom.llm.queries import PII_KEY, table, vocabulary
from termloom.llm.storage import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.without_personal_data(docs, PII_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: The trained scorer and the tokenizer are not SQL; tests/llm/test_queries.py checks each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each keeps is stored before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
