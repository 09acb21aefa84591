"""Class balance: weights and oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.hashing import unit_hash

# Copies made of a row at a time, and how such chunks are shared among tasks.
COPIES_PER_ROW = 10_000
CHUNKS_PER_TASK = 100
CHUNK_TASKS = 16


def split_by_class(df: DataFrame, label: str, positive: int = 1, negative: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows of the positive and of the negative class; null is in neither."""
    return df.filter(F.col(label) == positive), df.filter(F.col(label) == negative)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def class_weights(df: DataFrame, label: str, classes: int | None = None) -> DataFrame:
    """Weight total / (K * n) of each class, K being the classes that occur.

    Rows without a label belong to no class and are left out.
    """
    counts = class_counts(df.filter(F.col(label).isNotNull()), label)
    sums = counts.agg(F.struct(F.sum("n_rows").alias("total"), F.count(F.lit(1)).alias("k"))).scalar()
    k = F.lit(classes) if classes is not None else sums["k"]
    return counts.withColumn("weight", sums["total"] / (k * F.col("n_rows")))


def with_class_weights(df: DataFrame, label: str, output: str, classes: int | None = None) -> DataFrame:
    """Each row with the weight of its class, null for a row without a label.

    The label may have any number of values: their weights are joined, and the plan
    is left to Spark, which knows the size of the weights when it runs the join.
    """
    weights = class_weights(df, label, classes).select(F.col(label).alias("_class"), F.col("weight").alias(output))
    return df.join(weights, F.col(label) == F.col("_class"), "left").drop("_class")


def with_binary_weights(df: DataFrame, label: str, output: str) -> DataFrame:
    """``y*w1 + (1-y)*w0`` with w = total / (2 n); a class without rows weighs 0."""
    y = F.col(label).cast("double")
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("n1"),
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count(F.lit(1)).alias("n"),
    )

    def weight(n: str) -> Column:
        return F.when(F.col(n) > 0, F.col("n") / (2 * F.col(n))).otherwise(F.lit(0.0))

    weights = counts.select(F.struct(weight("n1").alias("w1"), weight("n0").alias("w0"))).scalar()
    return df.withColumn(output, y * weights["w1"] + (1 - y) * weights["w0"])


def oversample_minority(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int = 42,
    minority: int = 1,
    majority: int = 0,
    copy_column: str | None = None,
    copies_per_row: int = COPIES_PER_ROW,
) -> DataFrame:
    """All majority rows, and the minority rows repeated up to the same number.

    With m = majority / minority each minority row comes floor(m) times, and
    once more where the hash of its key is below the rest of m. The row's key
    alone decides, so partitioning and retries do not change the result, and one
    scan yields both classes. ``copy_column`` numbers the copies of a row.

    Where a row has more than ``copies_per_row`` copies, they are made in chunks
    which are dealt out first, so that many tasks share the copies of one row. That
    changes the plan only; the majority is not shuffled in either.
    """
    counts = df.agg(
        F.count_if(F.col(label) == majority).alias("n0"), F.count_if(F.col(label) == minority).alias("n1")
    ).first()
    ratio = counts["n0"] / counts["n1"] if counts["n1"] else 0.0
    whole = int(ratio)
    extra = (unit_hash(*keys, purpose="copy", seed=seed) < F.lit(ratio - whole)).cast("bigint")
    copies = F.when(F.col(label) == majority, F.lit(1)).otherwise(F.lit(whole) + extra)
    out = copy_column or "_copy"
    if whole < copies_per_row:
        rows = df.filter(F.col(label).isin(majority, minority)).withColumn("_copies", copies)
        repeated = _repeated(rows, F.lit(1), F.col("_copies"), out).drop("_copies")
    else:
        small, large = split_by_class(df, label, minority, majority)
        counted = small.withColumn("_copies", copies)
        first = F.sequence(F.lit(1), F.col("_copies"), F.lit(copies_per_row))
        chunks = counted.withColumn("_first", F.explode(first))
        tasks = max(CHUNK_TASKS, -(-counts["n0"] // (copies_per_row * CHUNKS_PER_TASK)))
        dealt = chunks.repartition(tasks, *keys, "_first")
        last = F.least(F.col("_copies"), F.col("_first") + (copies_per_row - 1))
        many = _repeated(dealt, F.col("_first"), last, out).drop("_copies", "_first")
        repeated = large.withColumn(out, F.lit(1)).unionByName(many)
    return repeated if copy_column else repeated.drop(out)


def _repeated(rows: DataFrame, first: Column, last: Column, output: str) -> DataFrame:
    """Each row once for every number from ``first`` to ``last``."""
    numbers = F.sequence(first.cast("int"), last.cast("int"))
    return rows.filter(last >= first).withColumn(output, F.explode(numbers))


def oversample_poisson(
    df: DataFrame, label: str, seed: int = 42, minority: int = 1, majority: int = 0
) -> DataFrame:
    """The random form: the minority drawn with replacement, joined by union.

    Which rows are drawn depends on the partitioning of the input.
    """
    small, large = split_by_class(df, label, minority, majority)
    row = df.agg(
        F.count_if(F.col(label) == majority).alias("n0"), F.count_if(F.col(label) == minority).alias("n1")
    ).first()
    drawn = small.sample(withReplacement=True, fraction=row["n0"] / max(row["n1"], 1), seed=seed)
    return large.unionByName(drawn)
