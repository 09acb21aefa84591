"""A keyed hash in [0, 1), the same for a row wherever it is computed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 4294967296.0  # 2**32, the range of eight hexadecimal digits


def unit_hash(*keys: str | Column, purpose: str, seed: int = 42) -> Column:
    """Uniform value in [0, 1) of the key columns, a seed and a purpose.

    Unlike ``rand`` it depends on the row's key only: not on how the rows are
    partitioned, nor on which attempt of a task computes it. Values of different
    purposes are independent: a choice among rows that another choice has left must
    not use the value of that choice again.
    """
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws(":", *parts, F.lit(f"{seed}:{purpose}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_RANGE)
