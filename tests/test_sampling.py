"""Exact cuts, positions and samples against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from termloom.operators import ordering, sampling


def drawn(seed, *parts):
    return hashlib.md5("|".join(map(str, (seed, *parts))).encode()).hexdigest()


def keys(spark, n, partitions=5):
    return spark.range(0, n, 1, partitions).select(F.concat(F.lit("k"), "id").alias("key"))


def lowest(n, count, seed, salt):
    return set(sorted((f"k{i}" for i in range(n)), key=lambda k: drawn(seed, k, salt))[:count])


@pytest.mark.parametrize("n", [1, 2, 7, 500, 3000])
def test_exact_fraction(spark, n):
    found = [r.key for r in sampling.exact_fraction(keys(spark, n), "key").collect()]
    size = max(1, int(n * 0.05))
    assert len(found) == size
    assert set(found) == lowest(n, size, 42, "holdout")


def test_cut_with_shared_leading_digits(spark):
    """Draws that agree in their first four and eight digits are still told apart."""
    heads = ["0000" "0000", "0000" "0001", "aaaa" "0000", "aaaa" "0000"]
    draws = [f"{h}{i:024x}" for i, h in enumerate(heads * 20)]
    df = spark.createDataFrame([(d,) for d in draws], "drawn string")
    for size in (1, 19, 20, 21, 40, 41, 60, 79, 80):
        cut = ordering.cut_point(df, "drawn", lambda n, s=size: F.lit(s)).first().cut
        assert cut == sorted(draws)[size - 1]
    above = ordering.cut_point(df, "drawn", lambda n: F.lit(999)).first().cut
    assert above == max(draws)
    assert ordering.cut_point(df, "drawn", lambda n: F.lit(0)).collect() == []


def test_cut_of_nothing(spark):
    empty = keys(spark, 0)
    assert sampling.exact_fraction(empty, "key").count() == 0
    assert sampling.label_split(empty, "key").count() == 0


def test_split_is_disjoint_and_whole(spark):
    rows = keys(spark, 1001)
    train, held = sampling.train_eval_split(rows, "key")
    train, held = {r.key for r in train.collect()}, {r.key for r in held.collect()}
    assert len(held) == 51 and not train & held and len(train | held) == 1001
    assert held == lowest(1001, 51, 3407, "split")
    everything, nothing = sampling.train_eval_split(rows, "key", ratio=0)
    assert everything.count() == 1001 and nothing is None


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_sample_does_not_depend_on_partitions(spark, partitions):
    rows = keys(spark, 400).repartition(partitions)
    assert {r.key for r in sampling.exact_fraction(rows, "key").collect()} == lowest(
        400, 20, 42, "holdout"
    )


def test_cap_rows(spark):
    rows = keys(spark, 300)
    assert {r.key for r in sampling.cap_rows(rows, "key", 50).collect()} == lowest(300, 50, 42, "cap")
    assert sampling.cap_rows(rows, "key", 300).count() == 300
    assert sampling.cap_rows(rows, "key", 999).count() == 300
    assert sampling.cap_rows(rows, "key", None).count() == 300


def test_repeated_and_missing_keys_raise(spark):
    repeated = spark.createDataFrame([("k",)] * 9 + [("m",)], "key string")
    with pytest.raises(Exception, match="must not repeat"):
        sampling.cap_rows(repeated, "key", 5).collect()
    with pytest.raises(Exception, match="NULL key"):
        sampling.cap_rows(spark.createDataFrame([(None,), ("k",)], "key string"), "key", 1).collect()


def test_cap_rows_beyond_ten_thousand(spark):
    rows = spark.range(30_000).selectExpr("cast(id as string) as key")
    for count in (9_995, 10_007):
        assert sampling.cap_rows(rows, "key", count).count() == count


@pytest.mark.parametrize("threshold", ["1000", "0"])
def test_stratified_sample_both_ways(spark, threshold):
    """One stratum holds most rows, one is NULL, some are smaller than asked for."""
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    strata = ["hot"] * 700 + ["mid"] * 90 + ["few"] * 5 + [None] * 30
    rows = spark.createDataFrame([(s, f"k{i}") for i, s in enumerate(strata)], "s string, key string")
    groups = defaultdict(list)
    for i, s in enumerate(strata):
        groups[s].append(f"k{i}")
    expected = {
        (s, k)
        for s, members in groups.items()
        for k in sorted(members, key=lambda k: drawn(42, k, "stratum"))[:40]
    }
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        found = sampling.stratified_sample(rows, "s", "key", 40)
        assert found.columns == ["s", "key"]
        found = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.set(name, before)
    assert len(found) == len(expected) == 40 + 40 + 5 + 30
    assert set(found) == expected


@pytest.mark.parametrize("run", [100_000, 3])
def test_sample_ids_of_copies(spark, monkeypatch, run):
    monkeypatch.setattr(sampling, "COPIES_PER_RUN", run)
    texts = ["same"] * 40 + ["x", "y", None, None] + ["z"] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = sampling.with_sample_id(rows).collect()
    assert Counter(r.t for r in found) == Counter(texts)
    assert len({r.sample_id for r in found}) == len(texts)
    copies = sorted(int(r.sample_id.split("-")[1]) for r in found if r.t == "same")
    assert copies == list(range(40))


def test_row_index_is_dense(spark):
    rows = sampling.with_draw(keys(spark, 777), "key", 1, "s")
    found = {r.drawn: r.row_index for r in ordering.row_index(rows, "drawn").collect()}
    assert [found[d] for d in sorted(found)] == list(range(777))


def test_shuffle_rows_is_one_global_order(spark):
    rows = sampling.with_draw(keys(spark, 500), "key", 42, "shuffle")
    for partitions in (1, 3, 8):
        moved = ordering.shuffle_rows(rows, "drawn", partitions)
        assert moved.rdd.getNumPartitions() == partitions
        order = [r.drawn for r in moved.collect()]
        assert order == sorted(order) and len(order) == 500


def test_rank_by_with_hot_values(spark):
    rows = keys(spark, 600).withColumn("v", F.when(F.rand(3) < 0.5, 0.0).otherwise(F.rand(5)))
    rows = rows.cache()
    ranked = ordering.rank_by(rows, "v", "key", descending=True).collect()
    ranked.sort(key=lambda r: r.position)
    assert [r.position for r in ranked] == list(range(600))
    assert [(r.v, r.key) for r in ranked] == sorted(
        ((r.v, r.key) for r in rows.collect()), key=lambda p: (-p[0], p[1])
    )
    best = ordering.top_scores(rows, "v", "key", 10).collect()
    assert sorted((r.position, r.key) for r in best) == [(r.position, r.key) for r in ranked[:10]]


def test_exclude_holdout(spark):
    rows = keys(spark, 100).withColumn("q", F.lower("key"))
    held = sampling.exact_fraction(rows, "key")
    assert sampling.exclude_holdout(rows, held, "key").count() == 95
    assert sampling.exclude_holdout(rows, held, F.md5("q")).count() == 95
    assert sampling.exclude_holdout(rows, held, "key", mode="reference").count() == 100
    with pytest.raises(ValueError):
        sampling.exclude_holdout(rows, held, "key", mode="other")


def test_leakage_counts_every_level(spark):
    schema = "question string, ground_truth string"
    train = spark.createDataFrame([("q1", "가 a"), ("q2", "나 b"), ("q2", "나 b")], schema)
    held = spark.createDataFrame(
        [("q1", "다 z"), ("q1", "가 a"), ("q9", "나 c"), ("q8", "no word")], schema
    )
    report = {r.level: (r.evaluated, r.leaked) for r in sampling.leakage_report(train, held).collect()}
    assert report == {"question": (4, 2), "pair": (4, 1), "headword": (3, 2)}
    nothing = sampling.leakage_report(train.limit(0), held.limit(0)).collect()
    assert {(r.level, r.evaluated, r.leaked) for r in nothing} == {
        (level, 0, 0) for level in report
    }


@pytest.mark.parametrize("range_bytes", [1 << 20, 20_000, 4_000])
def test_ranges_hold_at_most_the_bytes_asked_for(spark, range_bytes):
    rows = sampling.with_draw(keys(spark, 800), "key", 42, "shuffle").withColumn("text", F.repeat(F.lit("x"), 90))
    moved = ordering.shuffle_rows(rows, "drawn", range_bytes=range_bytes, size=F.octet_length("text"))
    held = moved.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b <= range_bytes or r.n == 1 for r in held) and sum(r.n for r in held) == 800
    order = [r.drawn for r in moved.collect()]
    assert order == sorted(order)
    # The next smaller number of ranges would not do.
    n = moved.rdd.getNumPartitions()
    assert n == 1 or max(r.b for r in ordering.shuffle_rows(rows, "drawn", n // 2).groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("b")).collect()) > range_bytes


def test_ranges_of_tables_beyond_the_first_counters(spark, monkeypatch):
    monkeypatch.setattr(ordering, "STEP_DIGITS", 1)
    rows = sampling.with_draw(keys(spark, 400), "key", 42, "shuffle")
    assert 64 <= ordering.range_count(rows, "drawn", F.lit(10), 60) <= 512
    assert ordering.range_count(rows.limit(0), "drawn", F.lit(10), 60) == 1
    assert ordering.range_count(rows.limit(1), "drawn", F.lit(10), 1) == 1


def ranked_by(spark, rows, descending, group_rows):
    df = spark.createDataFrame(rows, "v double, key string, position string").repartition(5)
    found = ordering.rank_by(df, "v", "key", descending, "at", group_rows)
    assert found.columns == ["v", "key", "position", "at"]
    return sorted((r["at"], r.v, r.key) for r in found.collect())


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("group_rows", [1_000_000, 40, 1])
def test_rank_by_of_odd_values(spark, descending, group_rows):
    rng = random.Random(7)
    odd = [float("inf"), float("-inf"), float("nan"), None, 0.0, -0.0, 5e-324, 1.7e308, -1.7e308]
    values = [rng.choice(odd) if i % 5 == 0 else 0.25 if i % 3 else rng.uniform(-1, 1) for i in range(500)]
    rows = [(v, f"k{i:04d}", None) for i, v in enumerate(values)]
    got = ranked_by(spark, rows, descending, group_rows)
    assert [at for at, _, _ in got] == list(range(500))
    df = spark.createDataFrame(rows, "v double, key string, position string")
    order = F.col("v").desc() if descending else F.col("v").asc()
    assert [k for _, _, k in got] == [r.key for r in df.orderBy(order, "key").collect()]


def test_rank_by_of_nothing_and_of_one_value(spark):
    assert ranked_by(spark, [], True, 10) == []
    assert [k for _, _, k in ranked_by(spark, [(1.0, f"k{i:03d}", "") for i in range(99)], True, 10)] == [f"k{i:03d}" for i in range(99)]


def test_one_value_in_a_third_of_the_rows_is_spread(spark):
    rows = spark.range(30_000).select(F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 30_000).alias("v"))
    cut, leaves = ordering.grouped_for_rank(rows, "v", "key", True, 100)
    sizes = cut.groupBy("_g1", "_g2", "_g3").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100 and leaves.count() == sizes.count()
    plan = ordering.rank_by(rows, "v", "key", True, group_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "RDD" not in plan and "Exchange SinglePartition" not in plan.split("WindowGroup")[0].split("hashpartitioning(_g1")[0]


def test_index_gives_the_same_cuts_and_positions(spark, tmp_path):
    from termloom.operators import rank_index

    rows = keys(spark, 5_000)
    index = rank_index.build_rank_index(rows, "key", str(tmp_path / "i"), sampling.DRAWS)
    for ratio in (0.05, 0.5, 1.0):
        a = sampling.exact_fraction(rows, "key", ratio, index=index)
        b = sampling.exact_fraction(rows, "key", ratio)
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    split = sampling.label_split(rows, "key", index=index)
    assert split.exceptAll(sampling.label_split(rows, "key")).count() == 0
    assert sampling.cap_rows(rows, "key", 77, index=index).exceptAll(sampling.cap_rows(rows, "key", 77)).count() == 0
    assert sampling.cap_rows(rows, "key", 9_999, index=index).count() == 5_000
    drawn_rows = sampling.with_draw(rows, "key", 42, "shuffle")
    expected = ordering.row_index(drawn_rows, "drawn").select("key", "row_index")
    assert index.position(rows, 42, "shuffle").exceptAll(expected).count() == 0
    cut = sampling.exact_fraction(rows, "key", index=index)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in cut
    empty = rank_index.build_rank_index(rows.limit(0), "key", str(tmp_path / "e"), sampling.DRAWS)
    assert sampling.exact_fraction(rows.limit(0), "key", index=empty).count() == 0
    twice = rank_index.build_rank_index(rows.limit(3).unionAll(rows.limit(3)), "key", str(tmp_path / "t"), sampling.DRAWS)
    with pytest.raises(Exception, match="must not repeat"):
        sampling.cap_rows(rows, "key", 1, index=twice).collect()
