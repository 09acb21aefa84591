"""Consecutive numbers for sorted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize

# Distinct values that one task numbers.
VALUES_PER_BUCKET = 1 << 16


def numbered(df: DataFrame, order: Sequence[Column], output: str) -> DataFrame:
    """0, 1, 2, ... in the given total order, from a materialized table.

    A global window would pull all rows into one task. Here the rows are sorted over
    all tasks, numbered within each sorted part, and moved up by the size of the
    parts before.
    """
    row_id = F.monotonically_increasing_id()
    # The upper bits of the id are the number of the sorted part, the lower 33 the place in it.
    parts = materialize(
        df.orderBy(*order).withColumn("_id", row_id).withColumns(
            {"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "sorted",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per sorted part, so never more than spark.sql.shuffle.partitions.
    placed = parts.join(F.broadcast(offsets), "_part").withColumn(output, F.col("_offset") + F.col("_place"))
    return materialize(placed.drop("_id", "_part", "_place", "_offset"), "numbered")


def value_numbers(df: DataFrame, column: str, output: str, values_per_bucket: int = VALUES_PER_BUCKET) -> DataFrame:
    """(value, n_rows, number): 0, 1, 2, ... for the different values of a column, stored.

    For numbers that need be no more than distinct: values are dealt by their hash, numbered
    within each bucket in their own order, and moved up by the sizes of the buckets before.
    Nothing is sorted over all tasks. The number of buckets follows from that of the values,
    so a value has the same number on any cluster. Null is no value.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    values = materialize(counts, "values")
    needed = -(-values.count() // values_per_bucket)
    buckets = 1 << max(needed - 1, 0).bit_length()
    dealt = values.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each bucket, a small part of a table that has 65,536 values to each.
    offsets = dealt.groupBy("_bucket").count().select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(column)) - 1
    placed = dealt.withColumn("_place", place).join(offsets, "_bucket")
    return materialize(placed.select(column, "n_rows", (F.col("_offset") + F.col("_place")).alias(output)), "value_numbers")
