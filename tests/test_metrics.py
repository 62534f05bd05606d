"""Statistics and scores against numpy and plain loops, with the empty and extreme cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.functions.similarity import greedy_match_f1
from termloom.operators import choice, compare, inference, overlap, profile, recall
from termloom.schemas import CHOICE_REPORT, RECALL_REPORT


def scores(spark, values, kind="double"):
    return spark.createDataFrame([(float(v),) for v in values], f"score {kind}")


def test_length_stats_equal_numpy(spark):
    values = np.random.default_rng(0).integers(1, 3000, 501)
    df = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "length int")
    row = profile.length_stats(df).first()
    assert (row.min, row.max, row.num_samples) == (values.min(), values.max(), 501)
    assert row["mean"] == pytest.approx(values.mean())
    for name, q in (("median", 50), ("p95", 95), ("p99", 99)):
        assert row[name] == pytest.approx(np.percentile(values, q))
    assert row.recommended_max_seq_length == 2048
    share = profile.over_limit_share(df, F.lit(1500)).first()
    assert (share.over_limit, share.num_samples) == ((values > 1500).sum(), 501)
    assert share.over_limit_percent == pytest.approx((values > 1500).mean() * 100)


def test_length_stats_of_nothing(spark):
    row = profile.length_stats(spark.createDataFrame([], "length int")).first()
    assert (row.min, row.p99, row.num_samples) == (None, None, 0)
    share = profile.over_limit_share(spark.createDataFrame([], "length int"), F.lit(5)).first()
    assert (share.over_limit, share.over_limit_percent) == (0, 0.0)


@pytest.mark.parametrize(
    "values",
    [
        [0.5] * 7,
        [0.0, 1.0],
        [i / 20 for i in range(21)],
        [i / 100 for i in range(101)],
        list(np.random.default_rng(1).normal(size=300)),
        [0.1, 0.2, 0.30000000000000004, 0.3, 0.7],
    ],
)
def test_histogram_equals_numpy(spark, values):
    rows = sorted(profile.histogram(scores(spark, values)).collect(), key=lambda r: r.bin)
    counts, edges = np.histogram(values, bins=20)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.low for r in rows] + [rows[-1].high] == pytest.approx(edges.tolist())


def test_score_summary_is_population(spark):
    row = profile.score_summary(scores(spark, [0.1, 0.4, 0.7])).first()
    assert (row.f1_mean, row.f1_std) == pytest.approx((0.4, np.std([0.1, 0.4, 0.7])))


@pytest.mark.parametrize("n, steps, interval", [(10, 0, 1), (64, 1, 1), (6400, 100, 10)])
def test_step_plan(spark, n, steps, interval):
    row = profile.step_plan(spark.range(n)).first()
    assert (row.steps_per_epoch, row.eval_steps, row.save_steps) == (steps, interval, interval)


ANSWERED = [
    ("1", "q1", "전술은 이것", "전술 탄도은(는) x ☜ TBM y", 0.9),
    ("2", "q2", "tbm", "정밀 은(는) x ☜ TBM", 0.7),
    ("3", "q3", "", "TERM x", 0.5),
    ("4", "q4", None, "유도 은(는) y", 0.5),
]
ANSWERED_SCHEMA = "sample_id string, question string, prediction string, ground_truth string, score double"


def test_both_headword_rules_and_abbreviation(spark):
    rows = recall.judged(spark.createDataFrame(ANSWERED, ANSWERED_SCHEMA))
    metric = rows.agg(
        recall.headword_accuracy("lenient").alias("lenient"),
        recall.headword_accuracy("strict").alias("strict"),
        recall.abbreviation_accuracy().alias("abbreviation"),
    ).first()
    assert tuple(metric.lenient) == (0.5, 2, 4)
    assert tuple(metric.strict) == (pytest.approx(1 / 3), 1, 3)
    assert tuple(metric.abbreviation) == (0.5, 1, 2)
    counts = recall.headword_counts(rows).first()
    assert (counts.correct, counts.incorrect) == (2, 2)
    details = recall.recall_details(rows.withColumn("row_index", F.lit(0))).collect()
    assert [(d.headword, d.headword_correct) for d in details] == [
        ("전술", True), ("정밀", False), (None, True), ("유도", False),
    ]


def test_recall_of_nothing(spark):
    rows = recall.judged(spark.createDataFrame([], ANSWERED_SCHEMA))
    metric = rows.agg(
        recall.headword_accuracy("strict").alias("strict"),
        recall.abbreviation_accuracy().alias("abbreviation"),
    ).first()
    assert tuple(metric.strict) == (0.0, 0, 0)
    assert tuple(metric.abbreviation) == (None, None, 0)
    with pytest.raises(ValueError):
        recall.headword_accuracy("other")


def test_recall_report_shape_and_gates(spark):
    rows = recall.judged(spark.createDataFrame(ANSWERED, ANSWERED_SCHEMA))
    report = recall.recall_report(rows, "r", "t")
    assert report.schema.simpleString() == RECALL_REPORT.simpleString()
    row = report.first()
    assert row.bertscore.f1_mean == pytest.approx(0.65)
    assert (row.passed.bertscore, row.passed.headword, row.overall_passed) == (False,) * 3
    good = recall.recall_report(rows.filter("sample_id = '1'")).first()
    assert good.overall_passed and good.passed.bertscore and good.num_samples == 1
    check = recall.validation_report(rows).first()
    assert check.headword_recall == pytest.approx(1 / 3) and check.num_samples == 4


CHOSEN = "sample_id string, subject string, answer int, response string, question string, choices array<string>"


def chosen(spark, *rows):
    return choice.with_choice(
        spark.createDataFrame([(str(i), s, a, r, "q", ["w"] * 4) for i, (s, a, r) in enumerate(rows)], CHOSEN)
    )


def test_choice_report(spark):
    tuned = chosen(spark, ("Law", 0, "A"), ("Law", 1, "A"), ("Eco", 2, "c"), ("Eco", 3, "?"))
    base = chosen(spark, ("Law", 0, "A"), ("Law", 1, "B"), ("Eco", 2, "c"), ("Eco", 3, "?"))
    row = choice.choice_report(tuned, base, "r", "t").first()
    assert row.finetuned.accuracy == 0.5 and row.base.accuracy == 0.75
    assert row.finetuned.by_subject["Law"].asDict() == {"accuracy": 0.5, "correct": 1, "total": 2}
    assert row.performance_drop == pytest.approx(0.25)
    assert (row.passed.drop_acceptable, row.passed.min_accuracy_met) == (False, True)
    assert row.overall_passed is False
    alone = choice.choice_report(tuned)
    assert alone.schema.simpleString() == CHOICE_REPORT.simpleString()
    assert alone.first().overall_passed is True and alone.first().base is None
    levels = {(r.level, r.subject): (r.correct, r.total) for r in choice.accuracy(tuned).collect()}
    assert levels == {("overall", None): (2, 4), ("subject", "Law"): (1, 2), ("subject", "Eco"): (1, 2)}


def test_choice_of_nothing(spark):
    (overall,) = choice.accuracy(chosen(spark).limit(0)).collect()
    assert (overall.level, overall.accuracy, overall.total) == ("overall", 0.0, 0)


def test_choice_details(spark):
    rows = chosen(spark, ("Law", 4, "B"), ("Law", 1, "?")).withColumn("row_index", F.lit(0))
    first, second = choice.choice_details(rows).collect()
    assert (first.ground_truth, first.prediction, first.correct) == ("4", "B", False)
    assert (second.ground_truth, second.prediction, second.prediction_idx) == ("B", "INVALID", -1)


def test_compare_reports(spark):
    from termloom.plans.training import compare_reports

    def pair(f1, headword, accuracy):
        recall_report = spark.createDataFrame([((f1,), (headword,))], "bertscore struct<f1_mean:double>, headword_recall struct<accuracy:double>")
        choice_report = spark.createDataFrame([((accuracy,),)], "finetuned struct<accuracy:double>")
        return recall_report, choice_report

    row = compare_reports(pair(0.8, 0.9, 0.5), pair(0.75, 0.8, 0.6), run_name="r").first()
    assert row.fp16.test1_bertscore_f1 == 0.8 and row.gguf.test2_accuracy == 0.6
    assert row.performance_drop.test1_headword_recall == pytest.approx(0.1)
    assert row.passed.asDict() == {
        "test1_bertscore": 0.8 - 0.75 <= 0.05,
        "test1_headword": False,
        "test2_accuracy": True,
    }
    assert row.overall_passed is False


def test_unshared_samples(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("b", 3)], "variant string, sample_id int")
    row = compare.unshared_samples(rows, "a", "b").first()
    assert (row.only_first, row.only_second) == (1, 1)


def test_greedy_match_equals_loops(spark):
    rng = np.random.default_rng(2)
    texts = [(rng.normal(size=(p, 8)), rng.normal(size=(r, 8))) for p, r in ((3, 5), (1, 1), (7, 2))]
    rows = [(i, p.tolist(), r.tolist()) for i, (p, r) in enumerate(texts)]
    rows += [(3, [], [[1.0] * 8]), (4, [[0.0] * 8], [[1.0] * 8]), (5, None, [[1.0] * 8])]
    df = spark.createDataFrame(rows, "i int, p array<array<float>>, r array<array<float>>")
    found = {r.i: r.s for r in df.select("i", greedy_match_f1(F.col("p"), F.col("r")).alias("s")).collect()}
    for i, (p, r) in enumerate(texts):
        cosine = np.array([[a @ b / np.linalg.norm(a) / np.linalg.norm(b) for b in r] for a in p])
        precision, hit = cosine.max(axis=1).mean(), cosine.max(axis=0).mean()
        f1 = 2 * precision * hit / (precision + hit)
        assert tuple(found[i]) == pytest.approx((precision, hit, f1), abs=1e-5)
    assert tuple(found[3]) == tuple(found[4]) == tuple(found[5]) == (0.0, 0.0, 0.0)


def test_word_overlap_equals_one_hot_vectors(spark):
    texts = [("1", "a b a c", "a c d"), ("2", "", "a"), ("3", "x", "y"), ("4", " b  b", "b"), ("5", None, "")]
    df = spark.createDataFrame(texts, "id string, p string, r string")
    found = {r.id: (r.precision, r.recall, r.f1) for r in overlap.token_overlap_f1(df, "id", "p", "r").collect()}
    alphabet = "abcdxy"
    vectors = [
        (i, *([[float(w == c) for c in alphabet] for w in (t or "").split()] for t in (p, r)))
        for i, p, r in texts
    ]
    dense = spark.createDataFrame(vectors, "id string, p array<array<float>>, r array<array<float>>")
    for row in dense.select("id", greedy_match_f1(F.col("p"), F.col("r")).alias("s")).collect():
        assert found[row.id] == pytest.approx(tuple(row.s))


def test_word_overlap_counts_words_without_rows_of_words(spark):
    blank = chr(0x3000)  # no blank of Spark's expressions
    rows = [(i % 7 or None, f"a{blank}b c\x0bd w{i}", f"c d d a{blank}b") for i in range(40)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "id int, p string, r string").repartition(5)
    scored = overlap.token_overlap_f1(df, "id", "p", "r")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = {r.id: (r.precision, r.recall) for r in scored.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {**{i: (0.75, 1.0) for i in (None, *range(1, 7))}, 9: (0.0, 0.0)}
    assert scored.columns == ["id", "precision", "recall", "f1"]
    assert "Generate" not in scored._jdf.queryExecution().toString()


def test_batches_and_padding(spark):
    from termloom.operators.sampling import with_draw

    rows = spark.range(20).select(
        F.col("id").cast("string").alias("key"),
        F.sequence(F.lit(1), (F.col("id") % 5 + 1).cast("int")).alias("ids"),
    )
    batched = inference.assign_batches(with_draw(rows, "key", 1, "b"), "drawn", 8)
    padded = inference.pad_batches(batched, pad_id=9).collect()
    sizes = sorted(sum(1 for r in padded if r.batch == b) for b in range(3))
    assert sizes == [4, 8, 8]
    for row in padded:
        width = max(len(r.ids) for r in padded if r.batch == row.batch)
        gap = width - len(row.ids)
        assert row.input_ids == [9] * gap + row.ids
        assert row.attention_mask == [0] * gap + [1] * len(row.ids)


def shouting_model():
    return lambda prompts: [f" {p.upper()}\n" if p != "none" else None for p in prompts]


def short_model():
    return lambda prompts: prompts[1:]


def test_predictions_keep_their_rows(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big + i, "abc"[i % 3], None) for i in range(25)] + [(1, "none", 1)], "id bigint, prompt string, n bigint")
    rows = inference.predict_batches(df, shouting_model, batch_size=4).collect()
    assert len(rows) == 26
    assert all(r.prediction == "ABC"[(r.id - big) % 3] for r in rows if r.id != 1)
    assert [(r.n, r.prediction) for r in rows if r.id == 1] == [(1, None)]
    with pytest.raises(Exception, match="answers"):
        inference.predict_batches(df, short_model).collect()
