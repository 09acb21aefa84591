from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

from tallywright.operators import metrics, thresholds

NAMES = {
    "accuracy": "accuracy",
    "weighted_precision": "weightedPrecision",
    "weighted_recall": "weightedRecall",
    "f1": "f1",
}


@pytest.fixture(scope="module")
def three(spark):
    r = random.Random(1)
    rows = [(float(r.choice([0, 0, 0, 1, 2])), float(r.choice([0, 1, 2]))) for _ in range(500)]
    return spark.createDataFrame(rows, "y double, p double").persist()


def evaluate(df, metric, **params):
    return MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=metric, **params).evaluate(df)


def test_report_equals_the_evaluators(three):
    ours = metrics.classification_report(three, "y", "p").first()
    for name, metric in NAMES.items():
        assert math.isclose(ours[name], evaluate(three, metric), rel_tol=1e-12)


def test_classes_equal_the_evaluators(three):
    for row in metrics.per_class_metrics(three, "y", "p").collect():
        for name, metric in (("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")):
            assert math.isclose(row[name], evaluate(three, metric, metricLabel=row["class"]), rel_tol=1e-12)


def test_never_predicted_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)], "y double, p double")
    ours = metrics.classification_report(df, "y", "p").first()
    for name, metric in NAMES.items():
        assert math.isclose(ours[name], evaluate(df, metric), abs_tol=1e-12)


def test_report_leaves_out_unknown_rows(spark):
    df = spark.createDataFrame([(0, 0.0), (1, None), (None, 1.0)], "y int, p double")
    assert metrics.classification_report(df, "y", "p").first()["accuracy"] == 1.0
    assert [r["class"] for r in metrics.per_class_metrics(df, "y", "p").collect()] == [0.0]
    assert metrics.classification_report(df.limit(0), "y", "p").first()["accuracy"] is None


def test_report_is_one_shuffle_of_rows(three):
    """Rows are counted before the first exchange, and read without a filter."""
    plan = metrics.classification_report(three, "y", "p")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Join" not in plan


def test_confusion_matrix_names(three):
    df = metrics.confusion_matrix(three, "y", "p", ("Actual", "Predicted"), "Count")
    assert df.columns == ["Actual", "Predicted", "Count"]
    assert sum(r["Count"] for r in df.collect()) == 500


def test_recall_without_positives(spark):
    df = spark.createDataFrame([(0, 1.0)], "y int, p double")
    assert metrics.positive_recall(df, "y", "p").first().asDict() == {"tp": 0, "fn": 0, "recall": 0.0}


def test_errors_equal_the_evaluator(three):
    ours = metrics.regression_metrics(three, "y", "p").first()
    for name in ("rmse", "mae"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(three)
        assert math.isclose(ours[name], theirs, rel_tol=1e-12)


def test_rounding_is_half_up_and_keeps_floats(spark):
    df = spark.createDataFrame([(1.005, 2.5), (-1.005, 0.125)], "d double, f float")
    out = metrics.with_rounded(metrics.with_rounded(df, "d", "a"), "f", "b", 0)
    assert [r["a"] for r in out.collect()] == [1.01, -1.01]
    assert out.schema["b"].dataType.simpleString() == "float"


@pytest.fixture(scope="module")
def scores(spark):
    r = random.Random(2)
    rows = [(int(r.random() < 0.3), r.random()) for _ in range(2000)]
    rows += [(i % 2, i * 0.01) for i in range(101)]  # exactly on each threshold
    rows += [(i % 3 // 2, i / 100) for i in range(101)]
    return rows


def brute(rows, t):
    tp = sum(1 for y, p in rows if p >= t and y == 1)
    fp = sum(1 for y, p in rows if p >= t and y == 0)
    fn = sum(1 for y, p in rows if p < t and y == 1)
    return tp, fp, fn, len(rows) - tp - fp - fn


def test_sweep_equals_brute_force(spark, scores):
    df = spark.createDataFrame(scores, "y int, p double")
    got = {r["step"]: r for r in thresholds.threshold_sweep(df, "y", "p").collect()}
    assert set(got) == set(range(101))
    for i, row in got.items():
        assert row["threshold"] == i * 0.01
        assert (row["tp"], row["fp"], row["fn"], row["tn"]) == brute(scores, i * 0.01)


def test_sweep_f1_equals_the_evaluator(spark, scores):
    df = spark.createDataFrame(scores, "y int, q double")
    sweep = thresholds.threshold_sweep(df, "y", "q").collect()
    for row in sweep[::25]:
        applied = thresholds.apply_threshold(df, "q", row["threshold"], "p")
        assert math.isclose(row["f1"], evaluate(applied, "f1"), rel_tol=1e-12)


def test_sweep_at_the_edges(spark):
    rows = [(1, math.nan), (1, 1.5), (0, -0.5), (1, None), (None, 0.5), (0, 0.0), (1, 1.0)]
    got = sorted(thresholds.threshold_sweep(spark.createDataFrame(rows, "y int, p double"), "y", "p").collect())
    first, last = got[0], got[-1]
    assert (first["tp"], first["fp"], first["fn"], first["tn"]) == (3, 1, 0, 1)
    assert (last["tp"], last["fp"], last["fn"], last["tn"]) == (3, 0, 0, 2)


def test_best_is_the_first_of_equal_thresholds(spark):
    df = spark.createDataFrame([(0, 0.2), (1, 0.6)], "y int, p double")
    best = thresholds.best_threshold(thresholds.threshold_sweep(df, "y", "p")).first()
    assert best["threshold"] == 21 * 0.01 and best["f1"] == 1.0


def test_best_of_nothing_is_the_default(spark):
    df = spark.createDataFrame([], "y int, p double")
    best = thresholds.best_threshold(thresholds.threshold_sweep(df, "y", "p")).first()
    assert best.asDict() == {"threshold": 0.5, "f1": 0.0}


def test_other_grids(spark, scores):
    df = spark.createDataFrame(scores, "y int, p double")
    got = thresholds.threshold_sweep(df, "y", "p", step=0.25, steps=4).collect()
    assert [(r["tp"], r["fp"], r["fn"], r["tn"]) for r in got] == [brute(scores, i * 0.25) for i in range(5)]


def test_applied_threshold_includes_the_bound(spark):
    df = spark.createDataFrame([(0.4,), (0.39,), (None,)], "p double")
    assert [r["x"] for r in thresholds.apply_threshold(df, "p", 0.4, "x").collect()] == [1.0, 0.0, None]


def test_sweep_reads_the_rows_once(spark, scores):
    df = spark.createDataFrame(scores, "y int, p double")
    plan = thresholds.threshold_sweep(df, "y", "p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
