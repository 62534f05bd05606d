"""Positions across files, tolerant subjects, batches by length, and the counted stream."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from termloom.operators import combine, inference, position
from termloom.operators.sampling import with_draw
from termloom.plans.standins import standin
from termloom.sources import subjects, vocab_csv
from termloom.streaming import feed

SF_DIR = "/root/testdata/sf0.001"


def test_places_count_over_all_files(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).select("id", F.concat(F.lit("t"), "id").alias("text"))
    rows.write.parquet(f"{tmp_path}/a")
    rows.select((F.col("id") * 2).alias("other")).coalesce(3).limit(900).write.parquet(f"{tmp_path}/b")
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    assert {(r.id, r.position) for r in position.with_position(a).collect()} == {(i, i) for i in range(1000)}
    found = position.align_by_position(a, b)
    assert found.columns == ["position", "id", "text", "other"]
    assert {(r.position, r.id, r.other) for r in found.collect()} == {(i, i, 2 * i) for i in range(900)}
    # A filter in front takes rows away, but no places.
    assert position.with_position(a).filter("id % 2 = 0").agg(F.max("position")).first()[0] == 998
    with pytest.raises(ValueError):
        position.align_by_position(a, a)


@pytest.fixture
def benchmark(spark, tmp_path):
    rows = [(s, f"q{i}", "a", "b", "c", "d", "E" if i == 1 else "A" if i else "?!") for s in ("Law", "Economics", "Psychology") for i in range(6)]
    df = spark.createDataFrame(rows, "subject string, question string, A string, B string, C string, D string, answer string")
    df.coalesce(1).write.partitionBy("subject").parquet(f"{tmp_path}/items")
    return f"{tmp_path}/items"


def test_missing_and_broken_subjects_become_warnings(spark, benchmark):
    broken = glob.glob(f"{benchmark}/subject=Economics/*.parquet")[0]
    for name in (broken, *glob.glob(f"{benchmark}/subject=Economics/.*.crc")):
        with open(name, "wb") as file:
            file.write(b"not a table" if name == broken else b"")
    spark.catalog.clearCache()
    items, warnings = subjects.load_subjects(spark, benchmark, ("Law", "Economics", "Nothing", "Law"))
    assert {r.subject for r in items.collect()} == {"Law"} and items.count() == 6
    found = {r.subject: r.reason for r in warnings.collect()}
    assert found["Nothing"] == "no folder" and found["Economics"].startswith("no row in part-") and len(found) == 2


def test_no_benchmark_at_all(spark, tmp_path):
    items, warnings = subjects.load_subjects(spark, f"{tmp_path}/none", ("Law", "Economics"))
    assert items.count() == 0 and {(r.subject, r.reason) for r in warnings.collect()} == {("Law", "no folder"), ("Economics", "no folder")}


def test_loaded_items_are_sampled_then_judged(spark, benchmark):
    found = subjects.load_choice_items(spark, benchmark, ("Law", "Psychology"), per_subject=99)
    assert {(r.subject, r.rejected) for r in found.rejected.collect()} == {("Law", 1), ("Psychology", 1)}
    assert found.items.count() == 10 and found.warnings.count() == 0
    assert len({r.sample_id for r in found.items.collect()}) == 10
    few = subjects.load_choice_items(spark, benchmark, ("Law", "Psychology"), per_subject=2)
    assert few.items.count() + few.rejected.agg(F.coalesce(F.sum("rejected"), F.lit(0))).first()[0] == 4


def prompts(spark, n):
    rng = random.Random(3)
    rows = [(f"k{i}", [1] * (5 if i % 3 == 0 else rng.randrange(40))) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, ids array<int>").withColumn("length", F.size("ids"))
    return with_draw(df, "key", 42, "batch")


def test_batches_by_length_are_dense_and_sorted(spark):
    rows = prompts(spark, 500)
    found = inference.assign_batches_by_length(rows, "length", "drawn", 16)
    assert found.columns == [*rows.columns, "batch"]
    got = sorted((r.batch, r.length, r.drawn) for r in found.collect())
    order = sorted((r.length, r.drawn) for r in rows.collect())
    assert [(n, d) for _, n, d in sorted(got, key=lambda x: x[1:])] == order
    assert [b for b, _, _ in sorted(got, key=lambda x: x[1:])] == [i // 16 for i in range(500)]
    drawn = inference.padding_share(inference.assign_batches(rows, "drawn", 16)).first()
    sorted_ = inference.padding_share(found).first()
    assert sorted_.tokens == drawn.tokens and sorted_.padding < drawn.padding / 4
    assert inference.assign_batches_by_length(rows.limit(0), "length", "drawn").count() == 0
    assert inference.padding_share(found.limit(0)).first().padding == 0.0


def test_missing_lengths_come_first(spark):
    rows = prompts(spark, 20).withColumn("length", F.when(F.col("length") != 5, F.col("length")))
    found = inference.assign_batches_by_length(rows, "length", "drawn", 100)
    assert found.count() == 20


@pytest.mark.parametrize("arrow", [10_000, 7])
def test_the_model_gets_planned_batches_whole(spark, arrow):
    rows = inference.assign_batches_by_length(prompts(spark, 200), "length", "drawn", 16).withColumn("prompt", F.col("key"))

    def load():
        return lambda asked: ["+".join(sorted(asked))] * len(asked)

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(arrow))
    try:
        found = inference.predict_planned(rows, load, tasks=3).collect()
    finally:
        spark.conf.set(name, before)
    asked = {}
    for r in rows.collect():
        asked.setdefault(r.batch, []).append(r.key)
    assert len(found) == 200 and all(r.prediction == "+".join(sorted(asked[r.batch])) for r in found)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = combine.drop_duplicates(standin(spark, SF_DIR, "vocab").drop("doc_id"))
    vocab_csv.write_vocab_csv(table.repartition(3), f"{tmp_path}/in")
    folder = f"{tmp_path}/out"
    assert feed.committed(spark, folder, "counts") is None
    rows = feed.vocab_stream(spark, f"{tmp_path}/in", 1)
    feed.write_counted(rows, folder, f"{tmp_path}/state").awaitTermination()

    def totals():
        counts = feed.committed(spark, folder, "counts")
        return {(r["count"], r.type): r.value for r in counts.groupBy("count", "type").agg(F.sum("value").alias("value")).collect()}

    first = totals()
    read = vocab_csv.read_vocab_csv(spark, f"{tmp_path}/in")
    chats = feed.committed(spark, folder, "chats")
    assert chats.count() == first["pairs", None] == 4 * combine.require_fields(read).count()
    assert first["entries", None] == read.count() and first["skipped", None] == read.count() - combine.require_fields(read).count()
    assert sum(v for (name, _), v in first.items() if name == "pairs of type") == first["pairs", None]
    # All batches once more, as after a lost checkpoint.
    feed.write_counted(rows, folder, f"{tmp_path}/state-2").awaitTermination()
    assert totals() == first and feed.committed(spark, folder, "chats").count() == chats.count()


def test_equal_evaluation_rows_get_ids_of_their_own(spark, tmp_path):
    from termloom.sources import jsonl

    rows = spark.createDataFrame([("q", "a"), ("q", "a"), ("q", None)], "question string, ground_truth string")
    jsonl.write_jsonl(rows, f"{tmp_path}/eval")
    found = jsonl.read_eval_samples(spark, f"{tmp_path}/eval")
    assert sorted(found.columns) == ["ground_truth", "question", "sample_id"]
    assert len({r.sample_id for r in found.collect()}) == 3


def test_paired_lists_are_cut_by_their_bytes(spark, monkeypatch, tmp_path):
    from termloom.plans import catalog

    monkeypatch.setattr(catalog, "FILE_BYTES", 10_000, raising=False)
    folders = iter([f"{tmp_path}/predictions", f"{tmp_path}/truths"])
    monkeypatch.setattr(catalog, "_new_folder", lambda spark, name: next(folders))
    found = catalog.QUERIES["paired_by_position"](spark, SF_DIR)
    assert found.count() == found.filter("prediction_id is not null").count() == 180
    for name in ("predictions", "truths"):
        assert len(glob.glob(f"{tmp_path}/{name}/part-*")) > 5
