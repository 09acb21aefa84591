"""Attach a lookup table to a large frame, whatever the size of either."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize

# Rows of one key that one task should get; a key with more is divided.
ROWS_PER_PART = 1_000_000


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    weight: str,
    spread: str,
    rows_per_part: int = ROWS_PER_PART,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join on one key. The lookup has one row per key and should
    be materialized, as it is read several times.

    ``weight`` is the lookup's column with the number of rows a key has in
    ``df``, ``spread`` a column of ``df`` that differs among the rows of a key.

    A key with more than ``rows_per_part`` rows is divided into as many parts as keep
    to that number, and its row of the lookup is repeated for each. Such keys are
    joined first, to give each row its part; how, and whether any side is small
    enough to be broadcast, is left to Spark, which knows the bytes. Rows with a null
    key match nothing and are spread as well.
    """
    parts = F.ceil(F.col(weight) / rows_per_part).cast("int")
    hot = materialize(lookup.filter(F.col(weight) > rows_per_part).select(on, parts.alias("_parts")), "hot_keys")
    number = F.pmod(F.xxhash64(spread), F.when(F.col(on).isNull(), F.lit(1 << 20)).otherwise(F.coalesce("_parts", F.lit(1))))
    salted = df.join(hot, on, "left").withColumn("_salt", number.cast("int"))
    every = F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)
    copies = lookup.withColumn("_salt", F.explode(every))
    return salted.join(copies, [on, "_salt"], how).drop("_salt", "_parts")
