"""Invariants of question-and-answer pairs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom.functions.questions import RESPONSES, TEMPLATES
from termloom.operators import combine, pairs
from termloom.plans.standins import standin
from termloom.schemas import VOCAB, VOCAB_HEADERS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocab(spark):
    return combine.drop_duplicates(standin(spark, SF_DIR, "vocab").drop("doc_id")).cache()


def test_four_distinct_types_per_valid_row(spark, vocab):
    made = pairs.qa_pairs(vocab)
    shape = made.groupBy("row_key").agg(
        F.count("*").alias("n"), F.countDistinct("type").alias("types")
    )
    valid = combine.require_fields(vocab).count()
    assert valid > 100
    assert shape.filter("n = 4 and types = 4").count() == valid == shape.count()
    assert made.select("sample_id").distinct().count() == 4 * valid
    skipped = pairs.count_skipped(vocab).first()
    assert (skipped.entries, skipped.skipped, skipped.pairs) == (
        vocab.count(),
        vocab.count() - valid,
        4 * valid,
    )


def test_types_follow_the_fields(spark, vocab):
    typed = pairs.explode_types(pairs.keyed_terms(vocab))
    wrong = typed.filter(
        "(type in (2, 7) and Abbreviation is null)"
        " or (type = 3 and (Original_Word is null or length(Original_Word) >= 50))"
        " or (type = 4 and Hypernym is null)"
        " or (type = 5 and Category is null and Hypernym is null)"
    )
    assert wrong.count() == 0
    assert {r.type for r in typed.select("type").distinct().collect()} == set(range(1, 10))


def test_all_types_when_asked_for(spark, vocab):
    every = pairs.explode_types(pairs.keyed_terms(vocab), pairs_per_row=99)
    sizes = {r.n for r in every.groupBy("row_key").agg(F.count("*").alias("n")).collect()}
    assert min(sizes) >= 4 and max(sizes) <= 9 and len(sizes) > 1
    total = pairs.count_skipped(vocab, pairs_per_row=99).first().pairs
    assert total == every.count()


@pytest.mark.parametrize("limit, asked", [(50, 0), (51, 1)])
def test_original_word_limit(spark, limit, asked):
    row = spark.createDataFrame([("가", "나", "x" * 50)], "Headword string, Meaning string, Original_Word string")
    made = pairs.qa_pairs(row, pairs_per_row=9, max_original_word_chars=limit)
    assert made.filter("type = 3").count() == asked


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_partitions_do_not_matter(spark, vocab, partitions):
    expected = Counter(map(tuple, pairs.qa_pairs(vocab).collect()))
    moved = vocab.orderBy(F.rand(7)).repartition(partitions)
    assert Counter(map(tuple, pairs.qa_pairs(moved).collect())) == expected


def test_seed_matters(spark, vocab):
    first, second = (pairs.qa_pairs(vocab, seed=s).select("sample_id") for s in (42, 43))
    assert first.exceptAll(second).count() > 0


def test_draws_are_spread(spark):
    rows = spark.range(6000).select(
        F.concat(F.lit("w"), "id").alias("Headword"), F.lit("m").alias("Meaning"),
        F.lit("A").alias("Abbreviation"), F.lit("o").alias("Original_Word"),
        F.lit("h").alias("Hypernym"),
    )
    made = pairs.qa_pairs(rows).select("type", "question")
    counts = {r.type: r["count"] for r in made.groupBy("type").count().collect()}
    assert sum(counts.values()) == 24_000
    assert all(abs(n - 24_000 / 9) < 200 for n in counts.values())
    texts = made.filter("type = 1").select(F.regexp_replace("question", r"w\d+", "").alias("t"))
    per_template = [r["count"] for r in texts.groupBy("t").count().collect()]
    assert len(per_template) == len(TEMPLATES[1])
    assert all(abs(n - counts[1] / 4) < 120 for n in per_template)


def test_missing_columns_read_as_missing(spark):
    row = spark.createDataFrame([("가", "나")], "Headword string, Meaning string")
    assert {r.type for r in pairs.qa_pairs(row).collect()} == {1, 6, 8, 9}


def test_counts_by_type_are_ordered(spark, vocab):
    made = pairs.count_by_type(pairs.qa_pairs(vocab)).collect()
    assert [r.type for r in made] == sorted((r.type for r in made), key=str)


def test_every_type_has_an_answer():
    assert set(RESPONSES) == set(TEMPLATES) == set(range(1, 10))


def test_union_rename_and_duplicates(spark):
    first = spark.createDataFrame([("가", "a", "x"), ("가", "a", "x")], "`표제어` string, `의미` string, `기타` string")
    second = spark.createDataFrame([("나", None)], "`표제어` string, `약어` string")
    table = combine.rename_vocab(combine.union_all_by_name(first, second))
    assert table.columns == ["Headword", "Meaning", "기타", "Abbreviation"]
    counted = combine.count_duplicates(table).first()
    assert (counted.entries, counted.duplicates) == (3, 1)
    assert combine.drop_duplicates(table).count() == 2
    empty = combine.count_duplicates(spark.createDataFrame([], VOCAB)).first()
    assert (empty.entries, empty.duplicates) == (0, 0)
    assert len(VOCAB_HEADERS) == 13
