"""Columns of any name pass through the filtering operators; samples keep their share at any size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.llm import decontaminate, ngram_jaccard, storage, weak_quality

SCHEMA = "doc_id long, text string, row_ int, found string, quality_score_ double, n_entities_ int, group string"


@pytest.fixture(scope="module")
def rows(spark):
    text = " ".join(f"word{i}" for i in range(150))
    made = [(1, text, 7, "a", 0.25, 1, "g"), (2, text, 8, "b", 0.5, 2, None), (3, "some of the other words stand here", 9, "c", None, 3, "h")]
    made += [(None, None, None, None, None, None, None), (4, "", 1, "", 1.0, 1, "")]
    return spark.createDataFrame(made, SCHEMA)


def kept(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_columns_pass_through(spark, rows):
    every = {r.doc_id: str(tuple(r)) for r in rows.collect()}
    one = ngram_jaccard.keep_one(rows)
    assert one.columns == rows.columns and kept(one) == sorted(every[i] for i in (1, 3, 4, None))
    items = spark.createDataFrame([(1, "the other words stand here")], "item_id long, text string")
    clean = decontaminate.without_contaminated(rows, items)
    assert clean.columns == rows.columns and kept(clean) == sorted(every[i] for i in (1, 2, 4, None))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    good = weak_quality.keep_good(rows, labels)
    assert good.columns == rows.columns and set(kept(good)) <= set(every.values())


def test_shares_of_any_size(spark):
    rows = spark.range(200_000)

    def share(x):
        return rows.filter(storage.sampled(x, 5, "id")).count() / 200_000

    assert share(1.0) == share(7.5) == 1.0 and share(0) == 0.0
    assert abs(share(0.25) - 0.25) < 0.01
    # Shares far below one in a million have a bound of their own.
    tiny = spark.range(20_000_000).filter(storage.sampled(1.5e-6, 5, "id")).agg(F.count("*")).first()[0]
    assert 8 <= tiny <= 70
