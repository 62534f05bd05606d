"""Vocabulary rows to question-and-answer pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termloom.functions import questions
from termloom.functions.chat import to_messages
from termloom.functions.terms import term_variants
from termloom.functions.validity import blanks_to_null, is_valid, with_vocab_columns
from termloom.operators.combine import require_fields, with_row_key
from termloom.schemas import REQUIRED_COLUMNS, VOCAB_COLUMNS

SEED = 42


def keyed_terms(df: DataFrame) -> DataFrame:
    """Usable rows with ``row_key``, and with blank optional fields turned into NULL."""
    return blanks_to_null(with_row_key(require_fields(with_vocab_columns(df))))


def row_fields() -> dict:
    return {name: F.col(name) for name in VOCAB_COLUMNS}


def explode_types(
    terms: DataFrame,
    seed: int = SEED,
    pairs_per_row: int = questions.PAIRS_PER_ROW,
    max_original_word_chars: int = questions.MAX_ORIGINAL_WORD_CHARS,
) -> DataFrame:
    """One row per picked question type. Types are picked first, texts are built afterwards."""
    conditions = questions.type_conditions(row_fields(), max_original_word_chars)
    picked = questions.picked_types(conditions, F.col("row_key"), seed, pairs_per_row)
    return terms.select("*", F.inline(picked)).drop("lot")


def qa_pairs(
    df: DataFrame,
    seed: int = SEED,
    pairs_per_row: int = questions.PAIRS_PER_ROW,
    max_original_word_chars: int = questions.MAX_ORIGINAL_WORD_CHARS,
) -> DataFrame:
    """``(sample_id, row_key, type, question, response)``, without any shuffle.

    Run it on deduplicated rows: then ``sample_id`` is unique. Rows that bring their ``row_key``
    spare the digest.
    """
    named = keyed_terms(df).withColumn("term", term_variants(row_fields()))
    picked = explode_types(named, seed, pairs_per_row, max_original_word_chars)
    kind, key, row = F.col("type"), F.col("row_key"), {**row_fields(), "term": F.col("term")}
    chosen = picked.withColumn("template", questions.template_index(kind, key, seed))
    return chosen.select(
        F.md5(F.concat_ws("|", key, kind.cast("string"))).alias("sample_id"),
        "row_key",
        "type",
        questions.question(kind, F.col("template"), row).alias("question"),
        questions.response(kind, row).alias("response"),
    )


def with_messages(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("messages", to_messages(F.col("question"), F.col("response")))


def count_by_type(pairs: DataFrame) -> DataFrame:
    """Pairs per type, ordered by the type as text."""
    return (
        pairs.groupBy("type")
        .agg(F.count("*").alias("samples"))
        .orderBy(F.col("type").cast("string"))
    )


def count_skipped(
    df: DataFrame,
    pairs_per_row: int = questions.PAIRS_PER_ROW,
    max_original_word_chars: int = questions.MAX_ORIGINAL_WORD_CHARS,
) -> DataFrame:
    """Rows, rows that give no pair, and pairs, in one pass and without building any text."""
    rows = with_vocab_columns(df)
    usable = F.lit(True)
    for name in REQUIRED_COLUMNS:
        usable = usable & is_valid(F.col(name))
    conditions = questions.type_conditions(row_fields(), max_original_word_chars)
    available = sum((c.cast("int") for c in conditions.values()), F.lit(0))
    return (
        blanks_to_null(rows.withColumn("usable", usable))
        .select(
            "usable",
            F.when(F.col("usable"), F.least(F.lit(pairs_per_row), available))
            .otherwise(0)
            .alias("pairs"),
        )
        .agg(
            F.count("*").alias("entries"),
            F.count_if(~F.col("usable")).alias("skipped"),
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
        )
    )
