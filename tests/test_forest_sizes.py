"""Forests over more rows than a test has: what they keep, and how scores are recomputed."""

from __future__ import annotations

import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallywright.operators import models, trees, tuning


@pytest.fixture(scope="module")
def rows(spark):
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        spark.range(400).select(
            F.col("id").alias("key"),
            (F.abs(F.hash("id")) % 50).cast("double").alias("x"),
            (F.col("id") % 7).cast("double").alias("y"),
            ((F.col("id") % 7 < 3) | (F.abs(F.hash("id")) % 50 > 40)).cast("int").alias("label"),
        )
    ).cache()


def fitted_with(monkeypatch):
    """What forests are fitted with: whether they keep nodes, and how many fits run at a time."""
    seen, at_once, lock = [], [0, 0], threading.Lock()
    fit = RandomForestClassifier.fit

    def watched(self, rows, params=None):
        with lock:
            at_once[0] += 1
            at_once[1] = max(at_once)
            seen.append(self.getCacheNodeIds())
        try:
            return fit(self, rows, params) if params else fit(self, rows)
        finally:
            with lock:
                at_once[0] -= 1

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    return seen, at_once


def test_nodes_are_kept_up_to_a_bound(rows, monkeypatch):
    """Beyond it the same model is fitted without them, alone or in a pipeline."""
    forest = models.forest_classifier("label", trees=4, depth=3)
    kept = models.fit(forest, rows, ["features", "label"], ["key"])
    seen, _ = fitted_with(monkeypatch)
    monkeypatch.setattr(models, "CACHED_NODES", 400 * 4 - 1)
    without = models.fit(forest, rows, ["features", "label"], ["key"])
    piped = models.fit(Pipeline(stages=[forest]), rows, ["features", "label"], ["key"]).stages[0]
    assert seen == [False, False] and forest.getCacheNodeIds()
    assert without.toDebugString.split("\n")[1:] == piped.toDebugString.split("\n")[1:] == kept.toDebugString.split("\n")[1:]


def test_vectors_are_made_once(rows, monkeypatch):
    """A forest at the end of a pipeline reads kept vectors, and is that of the plain pipeline."""
    forest, fit, seen = models.forest_classifier("label", trees=4, depth=3), RandomForestClassifier.fit, []
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["y", "x"], outputCol="features"), forest])
    with models.training_rows(rows.select("key", "x", "y", "label"), ["key"]) as placed:
        plain = pipeline.fit(placed)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: seen.append((df.storageLevel.useMemory, df.columns)) or fit(self, df))
    found = models.fit(pipeline, rows, ["x", "y", "label"], ["key"])
    assert seen == [(True, ["features", "label"])] and len(found.stages) == 2
    assert found.stages[1].toDebugString.split("\n")[1:] == plain.stages[1].toDebugString.split("\n")[1:]
    assert found.transform(rows.select("x", "y")).count() == 400


@pytest.mark.parametrize("search", ["forest", "grid"])
def test_searches_keep_no_more(rows, monkeypatch, search):
    """The largest forest of the grid decides, and figures are the same."""
    df, forest = rows.select("key", "features", "label"), models.forest_classifier("label", trees=1, seed=5)

    def found():
        if search == "forest":
            return tuning.forest_search(df, ["key"], forest, (2, 4), (2, 3), "label", tuning.recall_of(1.0))
        points = [{forest.numTrees: n, forest.maxDepth: 3} for n in (2, 4)]
        return tuning.grid_search(df, ["key"], [forest], points, "label", tuning.recall_of(1.0))

    before = found().averages
    monkeypatch.setattr(models, "CACHED_NODES", 400 * 4 - 1)
    seen, _ = fitted_with(monkeypatch)
    assert found().averages == before and not any(seen)


def test_large_folds_follow_one_another(rows, monkeypatch):
    seen, at_once = fitted_with(monkeypatch)
    forest = models.forest_classifier("label", seed=5)
    df = rows.select("key", "features", "label")
    tuning.forest_search(df, ["key"], forest, (2,), (2,), "label", tuning.recall_of(1.0), partitions=models.PARTITIONS + 1)
    assert len(seen) == 4 and at_once[1] == 1


def test_trees_are_walked_by_batch(rows):
    """No walk by expressions, row by row."""
    model = RandomForestClassifier(labelCol="label", numTrees=5, maxDepth=4, seed=3).fit(rows)
    again = trees.with_tree_probability(model.transform(rows), model, "again")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan
    found = again.select("again", vector_to_array("probability")[1].alias("p")).collect()
    assert len(found) == 400 and all(r["again"] == pytest.approx(r["p"], abs=1e-12) for r in found)
