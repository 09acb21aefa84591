from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import sharding
from tallywright.llm.queries import SHARDS, op3_sharding


def slow_table(names, slots):
    """Full preference orders, then one claim at a time."""
    names = sorted(names)
    orders = []
    for n in names:
        offset, skip = sharding._draw(n, "offset", slots), sharding._draw(n, "skip", slots - 1) + 1
        orders.append([(offset + i * skip) % slots for i in range(slots)])
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = i
    return [table[s] for s in range(slots)]


@pytest.mark.parametrize("count, slots", [(1, 7), (3, 13), (7, 101), (13, 13)])
def test_table_equals_full_preferences(count, slots):
    names = [f"s{i}" for i in range(count)]
    assert sharding.lookup_table(names, slots).tolist() == slow_table(names, slots)
    assert sharding.lookup_table(names[::-1], slots).tolist() == slow_table(names, slots)


def test_shares_differ_by_one_turn_and_follow_claims():
    sizes = np.bincount(sharding.lookup_table(SHARDS))
    assert sizes.max() - sizes.min() <= 1 and sizes.sum() == sharding.SLOTS
    a, b = np.bincount(sharding.lookup_table({"a": 1, "b": 3}, 10007))
    assert abs(b - 3 * a) <= 3


def test_few_keys_move_when_a_shard_goes():
    names = list(SHARDS)
    before, after = sharding.lookup_table(names), sharding.lookup_table(names[:-1])
    stayed = (before == after)[before != len(names) - 1].mean()
    assert stayed > 0.97


def test_query_places_every_document(spark, sf_dir):
    rows = op3_sharding(spark, sf_dir).collect()
    table, names = sharding.lookup_table(SHARDS), sorted(SHARDS)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()
    wanted = {r["doc_id"]: (r["h"] % sharding.SLOTS, names[table[r["h"] % sharding.SLOTS]]) for r in docs}
    assert len(rows) == len(wanted) and {r["doc_id"]: (r["slot"], r["shard"]) for r in rows} == wanted


def test_null_and_repeated_keys_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "x", 9), (1, "x", 9), (None, None, None)], "doc_id long, shard string, slot int")
    out = sharding.with_shard(df, ["doc_id"], ["a", "b"], 7)
    rows = out.collect()
    assert out.columns == ["doc_id", "slot", "shard"] and len(rows) == 3
    assert len({(r["slot"], r["shard"]) for r in rows if r["doc_id"] == 1}) == 1
    assert all(r["shard"] in "ab" for r in rows)
    assert sharding.with_shard(df.limit(0), ["doc_id"], ["a"], 7).count() == 0
    table, slots = sharding.lookup_table(["a", "b"], 7), [r[0] for r in df.select(sharding.slot_of("shard", "slot", slots=7)).collect()]
    by_own_names = sharding.with_shard(df, ["shard", "slot"], ["a", "b"], 7).collect()
    assert sorted((r["slot"], r["shard"]) for r in by_own_names) == sorted((s, "ab"[table[s]]) for s in slots)


def test_written_shards(spark, tmp_path):
    df = sharding.with_shard(spark.range(500), ["id"], ["a", "b", "c"], 101)
    sharding.write_shards(df, str(tmp_path / "out"), files=2)
    back = [r["id"] for n in "abc" for r in sharding.read_shard(spark, str(tmp_path / "out"), n).collect()]
    assert sorted(back) == list(range(500))


@pytest.mark.parametrize("shards, slots", [([], 7), (["a"], 8), ({"a": 0}, 7), ([str(i) for i in range(9)], 7)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)
