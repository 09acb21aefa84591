"""Grouped totals, top groups, and distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_totals(df: DataFrame, keys: Sequence[str | Column], value: str, output: str) -> DataFrame:
    """Sum per group. Each task adds up its own rows before the shuffle, so a
    group with very many rows arrives as one partial sum per task."""
    return df.groupBy(*keys).agg(F.sum(value).alias(output))


def top_groups(df: DataFrame, key: str, value: str, output: str, k: int) -> DataFrame:
    """The ``k`` groups of the highest total; equal totals in order of the key."""
    return group_totals(df, [key], value, output).orderBy(F.desc(output), F.asc(key)).limit(k)


def monthly_totals(df: DataFrame, date: str, value: str, output: str) -> DataFrame:
    """Sum per calendar month, in order of time."""
    keys = [F.year(date).alias("year"), F.month(date).alias("month")]
    return group_totals(df, keys, value, output).orderBy("year", "month")


def distinct_per_group(df: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Number of different values per group.

    Spark shuffles by key and value together first, so the values of one large
    group are counted by many tasks.
    """
    return df.groupBy(key).agg(F.countDistinct(value).alias(output))


def more_than(df: DataFrame, column: str, least: int) -> DataFrame:
    """Groups above a limit (the HAVING of a grouped frame)."""
    return df.filter(F.col(column) > least)


def with_several(df: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Whether each key has more than one different value: its smallest is not its largest.

    Both are combined in each task, so one row for each key and task is shuffled, and no
    pair of a key and a value. A null is no value, as in a count of distinct ones.
    """
    several = F.coalesce(F.min(value) != F.max(value), F.lit(False))
    return df.groupBy(key).agg(several.alias(output))


def repeat_rate(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share in percent of the keys with more than one different value."""
    per_key = with_several(df, key, value, "_several")
    counts = per_key.agg(
        F.count_if("_several").alias("repeat_customers"),
        F.count(F.lit(1)).alias("total_customers"),
    )
    rate = F.col("repeat_customers") / F.col("total_customers") * 100
    return counts.withColumn("repeat_rate", F.when(F.col("total_customers") > 0, rate).otherwise(F.lit(0.0)))


def distinct_guard(df: DataFrame, columns: Sequence[str], least: int = 2) -> DataFrame:
    """Number of distinct values per column, null being one, and whether it suffices."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*pairs))).groupBy("column_name", "value").count()
    return values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        (F.count(F.lit(1)) >= least).alias("enough"),
    )


def has_variety(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether each column holds at least two values, null being one.

    Whether any row differs from one of them answers that, so one pass over the rows is
    enough, and no value is shuffled or kept on the way.
    """
    one = df.select(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]).alias("one")).limit(1).scalar()
    checks = [
        F.coalesce(F.bool_or(~F.col(c).eqNullSafe(one.getField(f"_{i}"))), F.lit(False)).alias(c) for i, c in enumerate(columns)
    ]
    row = df.agg(*checks).first()
    return all(row[c] for c in columns)
