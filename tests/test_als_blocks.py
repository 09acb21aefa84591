from __future__ import annotations

import os

import numpy as np
from pyspark import SparkContext
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tallywright.operators import recommend


def test_blocks_are_few():
    """Every iteration sends a factor to each block, so their number grows only where one would be too large."""
    assert [recommend.blocks_for(n) for n in (0, 11 << 20, 216_000_000, 10 << 25, (10 << 25) + 1)] == [10, 10, 10, 10, 16]


def test_fit_has_those_blocks(spark, monkeypatch):
    """Rows are dealt over more partitions than there are blocks."""
    seen, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, rows: seen.append((self.getNumUserBlocks(), self.getNumItemBlocks(), rows.rdd.getNumPartitions())) or fit(self, rows))
    monkeypatch.setattr(recommend, "partitions_for", lambda n, least, per=10: max(least, -(-n // per)))
    rows = spark.range(300).select((F.col("id") % 20).alias("user_id"), (F.col("id") * 7 % 31).alias("product_id"), (F.col("id") % 5 + 1.0).alias("rating"))
    recommend.fit_als(recommend.als(max_iter=1), rows)
    recommend.fit_als(recommend.als(max_iter=1), rows, 3)
    assert seen == [(10, 10, 30), (3, 3, 3)]


def test_memory_is_left_to_the_blocks(spark, monkeypatch):
    """Nothing is kept in memory ahead of the blocks, between the steps, or behind them."""
    seen, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, rows: seen.append((self.getIntermediateStorageLevel(), self.getFinalStorageLevel(), rows.storageLevel.useMemory)) or fit(self, rows))
    rows = spark.range(300).select((F.col("id") % 20).alias("user_id"), (F.col("id") * 7 % 31).alias("product_id"), (F.col("id") % 5 + 1.0).alias("rating"))
    found = recommend.fit_als(recommend.als(max_iter=2), rows)
    assert seen == [("DISK_ONLY", "DISK_ONLY", False)] and found.model.userFactors.count() == 20


def test_a_broadcast_goes_with_its_round(spark, monkeypatch):
    made, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: made.append(broadcast(self, value)) or made[-1])
    values = np.random.default_rng(1).gamma(0.7, 1.0, (40, 4)).tolist()
    given = spark.createDataFrame(list(enumerate(values)), "id int, features array<float>")
    found = recommend.top_scores(given, given, 2, 4, 8 * 6 * 10)
    assert len(made) == 4 and not any(os.path.exists(b._path) for b in made)
    assert found.filter("size(best) = 2").count() == 40
