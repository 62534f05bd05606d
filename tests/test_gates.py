"""Reports hide no missing value, and gates do not pass on one."""

from __future__ import annotations

import pytest

from termloom.operators import choice, compare, recall


def metrics(spark, rows):
    return spark.createDataFrame(rows, "variant string, metric string, value double")


def test_missing_metric_fails_the_comparison(spark):
    names = ["test1_bertscore_f1", "test1_headword_recall", "test2_accuracy"]
    rows = [(v, m, 0.9) for v in ("full", "small") for m in names]
    whole = compare.comparison_report(compare.compare_variants(metrics(spark, rows), "full", "small"), "full", "small").first()
    assert whole.overall_passed and whole.passed.test1_headword and whole.passed.test2_accuracy
    for gap in (rows[1:], [(*rows[0][:2], None), *rows[1:]], [r for r in rows if r[1] != names[0]]):
        report = compare.comparison_report(compare.compare_variants(metrics(spark, gap), "full", "small"), "full", "small").first()
        assert not report.overall_passed and report.passed.test1_bertscore is False and report.passed.test2_accuracy
    with pytest.raises(Exception, match="more than one value"):
        compare.compare_variants(metrics(spark, [*rows, rows[0]]), "full", "small").collect()


def test_rows_without_subject_are_reported(spark):
    rows = spark.createDataFrame([(None, True), ("s", False), (None, False)], "subject string, correct boolean")
    report = choice.choice_report(rows).first()
    assert report.finetuned.total == 3 and report.finetuned.by_subject[choice.NO_SUBJECT].total == 2


def test_repeated_ids_are_not_multiplied(spark):
    sides = [spark.createDataFrame(r, "sample_id int, x int") for r in ([(1, 1), (2, 2), (None, 3)], [(1, 4), (1, 5)])]
    assert recall.align_predictions(sides[0], sides[0].withColumnRenamed("x", "y")).count() == 2
    with pytest.raises(Exception, match="repeated sample_id"):
        recall.align_predictions(sides[0], sides[1].withColumnRenamed("x", "y")).collect()


def test_unscored_rows_fail_the_semantic_gate(spark):
    rows = spark.createDataFrame([("a is b", "a is b", s) for s in (0.9, None)], "prediction string, ground_truth string, score double")
    report = recall.recall_report(recall.judged(rows)).first()
    assert report.num_samples == 2 and report.passed.bertscore is False and not report.overall_passed
    assert recall.recall_report(recall.judged(rows.filter("score is not null"))).first().passed.bertscore
