"""Fitting and scoring with the solvers of ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.numbers import class_probability
from tallywright.sources.scratch import ensure_checkpoint_dir

# Partitions that fits run over at least, and rows of one at most. The number follows from
# the rows alone, so that a model, whose draws follow from it, does not depend on the cluster.
PARTITIONS = 16
ROWS_PER_PARTITION = 1 << 20
# Bytes of the lists (the words of a text) of one partition at most. A kept partition that a task of
# another executor reads is copied whole, outside of what Spark's memory manager counts.
BYTES_PER_PARTITION = 1 << 27
# Rows times trees up to which a forest keeps the node each row has reached in each tree.
CACHED_NODES = 1 << 27


def partitions_for(rows: int, least: int = PARTITIONS, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """``least``, or the power of two by which no partition has many more than ``rows_per_partition``."""
    needed = -(-rows // rows_per_partition)
    return least if needed <= least else 1 << (needed - 1).bit_length()


def partitions_of(df: DataFrame) -> int:
    """Partitions for the rows of a frame: by their number, or by the bytes of their lists, 8 for each
    value beside those of its text, where these need more."""
    sizes = [
        F.size(f"`{name}`") * 8 + (F.octet_length(F.concat_ws("", f"`{name}`")) if kind == "array<string>" else 0)
        for name, kind in df.dtypes
        if kind.startswith("array<")
    ]
    if not sizes:
        return partitions_for(df.count())
    total = sum((F.coalesce(F.sum(size), F.lit(0)) for size in sizes), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), total).first()
    return max(partitions_for(rows), partitions_for(size, rows_per_partition=BYTES_PER_PARTITION))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory and on disk while several passes read it.

    Lost blocks are computed again from the source.
    """
    stored = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield stored
    finally:
        stored.unpersist()


def placed_rows(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """The rows in so many partitions by the hash of their keys, sorted within."""
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


@contextmanager
def training_rows(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> Iterator[DataFrame]:
    """The rows kept in partitions that follow from their keys alone.

    Forests draw their samples by partition and by the order of rows in it. With a
    given number of partitions, rows placed by the hash of the key and sorted within,
    a fit gives the same model on any number of cores and files. Unless given, the number
    follows from the rows (``partitions_of``).
    """
    partitions = partitions or partitions_of(df)
    with kept(placed_rows(df, keys, partitions)) as rows:
        yield rows


def logistic(label: str, max_iter: int = 10, threshold: float | None = None, **params: object) -> LogisticRegression:
    """Logistic regression; a threshold makes it predict 1 only above it."""
    model = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, **params)
    return model.setThreshold(threshold) if threshold is not None else model


def forest_classifier(
    label: str,
    trees: int = 20,
    depth: int = 5,
    weight: str | None = None,
    seed: int = 42,
    max_bins: int = 32,
    cache_nodes: bool = True,
) -> RandomForestClassifier:
    """``cache_nodes`` keeps the node each row has reached in each tree, rather
    than walking down all trees again at every level, where ``with_bounded_nodes`` allows it."""
    model = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxBins=max_bins,
        cacheNodeIds=cache_nodes,
    )
    return model.setWeightCol(weight) if weight is not None else model


def forest_regressor(
    label: str, trees: int = 50, depth: int = 6, seed: int = 42, cache_nodes: bool = True
) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        cacheNodeIds=cache_nodes,
    )


def with_bounded_nodes(estimator: Estimator, rows: int, trees: int = 0) -> Estimator:
    """The estimator, or one that keeps no nodes where a forest would have more than
    ``CACHED_NODES`` of them for so many rows and its own or ``trees`` trees.

    Of the nodes three tables exist at a time, each as large as rows times trees, and some are
    written whole. Without them each level walks down the trees again; the model is the same.
    """
    if isinstance(estimator, Pipeline):
        return Pipeline(stages=[with_bounded_nodes(stage, rows, trees) for stage in estimator.getStages()])
    if not estimator.hasParam("cacheNodeIds") or rows * max(trees, estimator.getNumTrees()) <= CACHED_NODES:
        return estimator
    return estimator.copy({estimator.cacheNodeIds: False})


def without_summary(model: Model) -> Model:
    """The model itself, its training summary dropped.

    The summary of a binary classifier holds the session. Where that has counted rows on
    their way to a write (``counting.StageCounts``) it cannot be sent to a task, and with it
    the model could score nothing.
    """
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def fit(
    estimator: Estimator, train: DataFrame, columns: Sequence[str], keys: Sequence[str], partitions: int | None = None
) -> Model:
    """Fit on the named columns only, kept for the passes of the solver and placed by the keys."""
    ensure_checkpoint_dir(train.sparkSession)
    with training_rows(train.select(*dict.fromkeys([*keys, *columns])), keys, partitions) as rows:
        return without_summary(_fit_encoded_once(with_bounded_nodes(estimator, rows.count()), rows))


def _fit_encoded_once(estimator: Estimator, rows: DataFrame) -> Model:
    """The same fit, a forest at the end of a pipeline reading kept vectors: it passes over its rows
    three times, for their number, for the bins and for its draws, before it keeps its own."""
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else []
    if len(stages) < 2 or not stages[-1].hasParam("cacheNodeIds"):
        return estimator.fit(rows)
    *ahead, forest = stages
    encoder = Pipeline(stages=ahead).fit(rows)
    weight = [forest.getWeightCol()] if forest.isDefined("weightCol") else []
    inputs = encoder.transform(rows).select(*dict.fromkeys([forest.getFeaturesCol(), forest.getLabelCol(), *weight]))
    with kept(inputs) as encoded:
        return PipelineModel([*encoder.stages, forest.fit(encoded)])


def with_class_probability(df: DataFrame, output: str = "probability_1", position: int = 1) -> DataFrame:
    return df.withColumn(output, class_probability(F.col("probability"), position))
