"""Shards that claim slots of a lookup table in turn, so that few keys move when shards change."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _draw(shard: str, purpose: str, bound: int) -> int:
    digest = hashlib.sha256(f"{purpose}:{shard}".encode()).digest()
    return int.from_bytes(digest[:8], "big") % bound


def lookup_table(shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> np.ndarray:
    """For each slot the place of its shard in the sorted names.

    A shard prefers the slots offset, offset + skip, offset + 2 skip, ... modulo a prime,
    so its order of preference holds each slot once. Shards take turns, each claiming
    its next free slot, until none is left; their shares differ by one turn at most.
    A mapping gives each shard its number of claims in a turn. The table depends on
    the names only, not on their order.
    """
    if not _prime(slots):
        raise ValueError(f"the number of slots must be prime: {slots}")
    names = sorted(set(shards))
    claims = [shards[n] if isinstance(shards, Mapping) else 1 for n in names]
    if not names or min(claims) < 1 or len(names) > slots:
        raise ValueError("from one shard to as many as there are slots, each with a claim or more")
    offset = [_draw(n, "offset", slots) for n in names]
    skip = [_draw(n, "skip", slots - 1) + 1 for n in names]
    step = [0] * len(names)
    table = np.full(slots, -1, np.int32)
    free = slots
    while True:
        for i, claim in enumerate(claims):
            for _ in range(claim):
                slot = (offset[i] + step[i] * skip[i]) % slots
                while table[slot] >= 0:
                    step[i] += 1
                    slot = (offset[i] + step[i] * skip[i]) % slots
                table[slot] = i
                free -= 1
                if not free:
                    return table


def slot_of(*keys: str | Column, slots: int = SLOTS) -> Column:
    """The slot of a row by its key columns; nulls have a slot as any value has."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def with_shard(
    df: DataFrame, keys: Sequence[str], shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS, output: str = "shard", slot: str = "slot"
) -> DataFrame:
    """``df`` with the slot and the shard of each row by its key columns.

    The table has ``slots`` rows, a number fixed by the caller and so the proven bound of
    the broadcast; each row is placed by one lookup, without a shuffle of ``df``. Columns
    of these names are replaced, key columns too, once they have told the slot.
    """
    names = sorted(set(shards))
    rows = [(i, names[s]) for i, s in enumerate(lookup_table(shards, slots).tolist())]
    table = df.sparkSession.createDataFrame(rows, f"`{slot}` int, `{output}` string")
    placed = df.withColumn(slot, slot_of(*keys, slots=slots)).drop(output)
    return placed.join(F.broadcast(table), slot).select(*[c for c in df.columns if c not in (slot, output)], slot, output)


def write_shards(df: DataFrame, path: str, files: int, shard: str = "shard", spread: Sequence[str] = ()) -> None:
    """One folder for each shard, of ``files`` files, by one shuffle. The rows of a shard are
    dealt over its files by the ``spread`` columns, or by all where none is named."""
    part = F.pmod(F.xxhash64(*(spread or df.columns)), F.lit(files))
    tasks = files * df.select(shard).distinct().count()
    df.repartition(max(tasks, 1), shard, part).write.partitionBy(shard).mode("overwrite").parquet(path)


def read_shard(spark: SparkSession, path: str, name: str, shard: str = "shard") -> DataFrame:
    """One shard of a written table; the folders of others are not listed for rows."""
    return spark.read.parquet(path).filter(F.col(shard) == name)
