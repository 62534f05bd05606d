"""Answers to scores, committed runs and the evaluation jobs."""

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.functions.similarity import best_cosines, match_scores
from termloom.operators import choice, inference, semantic
from termloom.plans import evaluation
from termloom.plans.standins import standin
from termloom.schemas import RECALL_REPORT
from termloom.sources import runs

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("m", "n", "tile"), [(1, 1, 4), (7, 5, 4), (40, 9, 8), (9, 33, 64)])
def test_tiles_find_the_best_cosines(m, n, tile):
    rng = np.random.default_rng(m * n)
    left, right = rng.normal(size=(m, 6)), rng.normal(size=(n, 6))
    whole = left @ right.T
    rows, columns = best_cosines(left, right, tile)
    assert rows == pytest.approx(whole.max(axis=1)) and columns == pytest.approx(whole.max(axis=0))


def test_match_scores_of_extremes():
    some = np.array([[1.0, 0.0], [0.0, 2.0]])
    assert match_scores(some, 3 * some) == pytest.approx({"precision": 1, "recall": 1, "f1": 1})
    zero = {"precision": 0.0, "recall": 0.0, "f1": 0.0}
    for other in (None, np.zeros((0, 2)), np.zeros((3, 2))):
        assert match_scores(some, other) == zero
    # Opposite directions: precision and recall of -1 have no harmonic mean of use, but no error either.
    assert match_scores(some[:1], -some[:1])["f1"] == -1.0


def one_hot():
    def encode(texts):
        return [None if t == "no vectors" else np.array([[float(w == x) for x in "abcd"] for w in t.split()]).reshape(-1, 4) for t in texts]

    return encode


def test_scores_stay_with_their_rows(spark):
    rows = [(1, "a b", "a b"), (2, "a", "a c"), (3, None, "a"), (4, "", ""), (5, "no vectors", "a"), (6, "a d", None), (2, "a", "a c")]
    df = spark.createDataFrame(rows, "sample_id int, prediction string, ground_truth string")
    for size in (1, 2, 64):
        found = semantic.semantic_scores(df, one_hot, batch_size=size, tasks=3)
        assert found.columns == [*df.columns, "precision", "recall", "score"]
        got = sorted((r.sample_id, r.precision, r.recall, r.score) for r in found.filter("score is not null").collect())
        assert got == [(1, 1.0, 1.0, 1.0), (2, 1.0, 0.5, 2 / 3), (2, 1.0, 0.5, 2 / 3), (3, 0, 0, 0), (4, 0, 0, 0), (6, 0, 0, 0)]
        assert found.filter("score is null").first().sample_id == 5
    assert semantic.semantic_scores(df.limit(0), one_hot).count() == 0
    with pytest.raises(Exception, match="2 texts, but vectors of 1"):
        semantic.semantic_scores(df.limit(1).withColumn("ground_truth", F.lit("x")), lambda: lambda texts: [None]).collect()


def noted(folder, made):
    """A loader that leaves a file for each time it runs."""

    def load():
        with open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w"):
            return made

    return load


@pytest.mark.parametrize("kind", ["encoder", "model"])
def test_a_worker_loads_once_for_a_hundred_tasks(spark, tmp_path, kind):
    rows = spark.range(0, 400, 1, 100).select("id", F.lit("a").alias("prediction"), F.lit("a b").alias("ground_truth"), F.lit("p").alias("prompt"))
    if kind == "encoder":
        found = semantic.semantic_scores(rows, noted(tmp_path, one_hot()))
    else:
        found = inference.predict_batches(rows, noted(tmp_path, lambda prompts: ["x"] * len(prompts)), output="answer")
    assert found.rdd.getNumPartitions() == 100
    assert found.agg(F.count("*")).first()[0] == 400 and found.agg(F.count("*")).first()[0] == 400
    loads = [name.split("-")[0] for name in os.listdir(tmp_path)]
    assert len(loads) == len(set(loads)) and len(loads) < 40


def test_models_get_their_limits(spark):
    rows = spark.createDataFrame([("abcdef",)] * 5, "prompt string")

    def load():
        return lambda prompts, max_new_tokens: [f"{len(prompts)} {max_new_tokens}"] * len(prompts)

    found = inference.predict_batches(rows.coalesce(1), load, batch_size=2, max_new_tokens=16, tasks=1)
    assert sorted(r.prediction for r in found.collect()) == ["1 16", "2 16", "2 16", "2 16", "2 16"]


def test_runs_are_committed_whole(spark, tmp_path):
    folder = str(tmp_path / "runs")
    with pytest.raises(LookupError):
        runs.read_run(spark, folder, "a", "report")
    first, second = spark.range(3), spark.range(5)
    runs.write_run(folder, "a", {"report": first, "details": first}, "t1", reports=("report",))

    def broken(i):
        raise RuntimeError("broken in between")

    bad = F.udf(broken, "long")
    with pytest.raises(Exception, match="broken in between"):
        runs.write_run(folder, "a", {"report": second, "details": second.select(bad("id").alias("id"))}, "t2")
    assert runs.read_run(spark, folder, "a", "report", first.schema).count() == 3
    assert runs.read_run(spark, folder, "a", "details").count() == 3
    runs.write_run(folder, "a", {"report": second}, "t3")
    runs.write_run(folder, "b", {"report": first}, "t3")
    assert runs.read_run(spark, folder, "a", "report").count() == 5
    assert {(r.run, r.version, r.timestamp) for r in runs.latest(spark, folder).collect()} == {("a", 1, "t3"), ("b", 0, "t3")}
    with pytest.raises(LookupError):
        runs.read_run(spark, folder, "a", "details")


def echo():
    return lambda prompts, max_new_tokens: [p.split("\n")[1].split("<")[0] for p in prompts]


def always(letter):
    return lambda: lambda prompts, max_new_tokens: [letter] * len(prompts)


def test_evaluation_and_comparison_read_committed_reports(spark, tmp_path):
    folder = str(tmp_path / "runs")
    samples = spark.createDataFrame([(str(i), f"전술 {i % 7} ", f"전술 {i % 5} 은(는) a b") for i in range(40)], "sample_id string, question string, ground_truth string")
    items = choice.choice_items(standin(spark, SF_DIR, "choice_source").select("sample_id", "subject", "question", "A", "B", "C", "D", "answer"))
    for variant in ("fp16", "gguf"):
        report = evaluation.run_recall(samples, echo, one_hot, folder, f"{variant}-recall", "now", 25, tasks=3)
        row = report.first()
        assert report.schema == RECALL_REPORT
        assert (row.num_samples, row.num_scored, row.num_unscored, row.headword_recall.accuracy) == (25, 25, 0, 1.0)
        report = evaluation.run_choice(items, always("C"), folder, f"{variant}-choice", "now", always("A") if variant == "fp16" else None)
        usable = choice.usable_items(items)
        assert report.first().finetuned.total == usable.count()
        assert report.first().finetuned.correct == usable.filter("answer = 2").count()
    details = runs.read_run(spark, folder, "fp16-recall", "details")
    assert sorted(r["index"] for r in details.collect()) == list(range(25))
    pairs = [("fp16-recall", "fp16-choice"), ("gguf-recall", "gguf-choice")]
    found = evaluation.run_comparison(spark, folder, *pairs, "compared", timestamp="now").first()
    assert found.performance_drop.test1_headword_recall == 0.0 and found.overall_passed and found.run_name == "compared"
    evaluation.run_recall(samples, echo, one_hot, folder, "gguf-recall", "later")
    with pytest.raises(ValueError, match="0 and 15 samples"):
        evaluation.run_comparison(spark, folder, *pairs, "again")
    assert evaluation.run_comparison(spark, folder, *pairs, "again", strict=False).first().overall_passed in (True, False)


def test_preparation_is_one_committed_run(spark, tmp_path):
    from datetime import datetime

    from termloom.operators import profile
    from termloom.plans import preparation
    from termloom.sources.settings import latest_config

    folder, settings = str(tmp_path / "runs"), str(tmp_path / "settings")
    vocab = standin(spark, SF_DIR, "vocab").drop("doc_id")
    counts = {(r["count"], r.type): r.value for r in preparation.run_combination(vocab.unionAll(vocab), folder, "combined").collect()}
    pairs = runs.read_run(spark, folder, "combined", "pairs")
    n = pairs.count()
    assert counts["pairs", None] == n == sum(v for (name, _), v in counts.items() if name == "pairs of type")
    assert counts["entries", None] == 2 * vocab.count() and counts["duplicates", None] >= vocab.count()
    chats = runs.read_run(spark, folder, "combined", "chats", "messages array<struct<role:string,content:string>>")
    assert chats.count() == n and chats.first().messages[0].role == "user"

    index = preparation.combined_index(spark, folder, "combined")
    ready = preparation.run_preparation(pairs, folder, "prepared", index=index, timestamp=datetime(2026, 1, 1), settings=settings)
    held = max(1, int(n * 0.05))
    trained = n - held
    validation = -(-trained * 5 // 100)
    assert ready.evaluation.count() == held and ready.validation.count() in (validation, validation + 1)
    assert ready.training.count() + ready.validation.count() == trained
    every = ready.evaluation.select("sample_id").unionAll(ready.training.select("sample_id")).unionAll(ready.validation.select("sample_id"))
    assert every.distinct().count() == n
    assert ready.steps.first().num_samples == ready.training.count()
    limit = ready.max_seq_length
    longer = ready.lengths.filter(F.col("length") > limit).agg(F.coalesce(F.sum("samples"), F.lit(0))).first()[0]
    assert (ready.over_limit.first().over_limit, ready.over_limit.first().num_samples) == (longer, n)
    assert limit == profile.stats_of_histogram(ready.lengths).first().recommended_max_seq_length
    found = {r.key: r.value for r in latest_config(spark.read.parquet(settings)).collect()}
    assert found == {"max_seq_length": str(limit), "run_name": "prepared"}

    plain = preparation.run_preparation(pairs, folder, "plain", eval_split=0, skip_analysis=True, max_seq_length=64, mode="reference")
    assert (plain.max_seq_length, plain.lengths, plain.validation) == (64, None, None)
    assert plain.training.count() == n and plain.steps.first().eval_steps is None
    assert {r.sample_id for r in plain.evaluation.collect()} == {r.sample_id for r in ready.evaluation.collect()}
    with pytest.raises(ValueError):
        preparation.run_preparation(pairs, folder, "bad", mode="other")
