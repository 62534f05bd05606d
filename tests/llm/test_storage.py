"""Texts that stay where they are stored while something is joined to them."""

from pyspark.sql import functions as F

from termloom.llm import storage, suffix_merge

SETTING = "spark.sql.requireAllClusterKeysForCoPartition"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_are_placed_are_joined_without_an_exchange(spark):
    rows = [(i % 90, f"text {i}" if i % 7 else None) for i in range(300)]
    docs = storage.placed(spark.createDataFrame(rows, "doc_id long, text string").repartition(11))
    assert docs.select("row_").distinct().count() == 300
    few = storage.stored(docs.filter("row_ % 3 = 0").select("row_", F.explode(F.array(F.lit(1), F.lit(2))).alias("x")))
    before = spark.conf.get(SETTING, "true")
    with storage.in_place(spark):
        both = storage.at_place(docs, few, "row_", F.sum("x").alias("x"), "left")
        plan = plan_of(both)
        got = sorted((r.row_, r.text or "", r.x) for r in both.collect())
    assert spark.conf.get(SETTING, "true") == before
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert got == sorted((r.row_, r.text or "", None if r.row_ % 3 else 3) for r in docs.collect())
    plain = docs.drop("part_")
    assert got == sorted((r.row_, r.text or "", r.x) for r in storage.at_place(plain, few, "row_", F.sum("x").alias("x"), "left").collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("placed_")]


def test_repeats_are_removed_without_moving_texts(spark, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{i} " * 40 + passage + f" {i * i}" * 50) for i in range(60)]
    plans, write = [], suffix_merge.stored

    def seen(df, *by):
        plans.append(plan_of(df))
        return write(df, *by)

    monkeypatch.setattr(suffix_merge, "stored", seen)
    assert suffix_merge.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).filter("n_removed > 0").count() == 60
    joined = [p for p in plans if "text#" in p and "ShuffledHashJoin" in p]
    assert len(joined) == 2 and all("Bucketed: true" in p for p in joined)
