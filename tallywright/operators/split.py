"""Train and test parts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.hashing import unit_hash


def with_part(
    df: DataFrame, keys: Sequence[str], output: str, weights: Sequence[float] = (0.8, 0.2), seed: int = 42, purpose: str = "split"
) -> DataFrame:
    """Number of the part (0, 1, ...) a row belongs to by the hash of its key.

    Parts of parts need another purpose, else the second choice follows from the first.
    """
    total = sum(weights)
    u = unit_hash(*keys, purpose=purpose, seed=seed)
    part = F.lit(len(weights) - 1)
    bounds = list(accumulate(w / total for w in weights))[:-1]
    for number, bound in reversed(list(enumerate(bounds))):
        part = F.when(u < bound, F.lit(number)).otherwise(part)
    return df.withColumn(output, part)


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Disjoint parts by the hash of the key; rows of one key stay together.

    A row's part never changes with the partitioning, and a retried task gives
    the same rows again, so nothing leaks from test to train.
    """
    total = sum(weights)
    bounds = [0.0, *accumulate(w / total for w in weights)]
    u = unit_hash(*keys, purpose="split", seed=seed)
    last = len(weights) - 1
    parts = []
    for i in range(len(weights)):
        inside = u >= bounds[i] if i else F.lit(True)
        if i != last:
            inside = inside & (u < bounds[i + 1])
        parts.append(df.filter(inside))
    return parts


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's own random split; membership depends on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def is_empty(df: DataFrame) -> bool:
    """Whether there is no row; reads no more than it must."""
    return df.isEmpty()
