from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallywright.llm import graph, simhash
from tallywright.llm.graph import components
from tallywright.llm.queries import op1_simhash


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows):
    """{position: (fingerprint, component_id)} by comparing every pair."""
    prints = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            lowest[find(i)] = min(d, lowest.get(find(i), d))
    return sorted(((d, f"{prints[i]:016x}", lowest.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op1_simhash(spark, sf_dir)) == slow_groups(rows)


def test_odd_texts(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [
        (3, None), (4, ""), (5, " \t\n"), (6, "One two"), (7, "one  TWO"), (7, "one  TWO"), (None, "one two"),
        (None, "É é x y z"), (9, "É é x y Z"), (10, long), (11, long + " more"), (12, "a b c d"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, fingerprint int")
    groups = simhash.simhash_groups(df)
    got = result(groups.withColumn("fingerprint", simhash.hexadecimal(groups["fingerprint"])))
    assert got == slow_groups(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(
        [(3, None, "x", 1), (6, "One two", "x", 1), (9, "É é x y Z", "x", 1), (10, long, "x", 1), (12, "a b c d", "x", 1)],
        key=str,
    )


def test_of_repeated_and_nameless_rows_one_stays(spark):
    df = spark.createDataFrame([(None, "p q r s t"), (None, "p q r s t"), (2, "k l m"), (2, "k l m")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(df).collect()), key=str) == [(2, "k l m"), (None, "p q r s t")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0
    assert simhash.keep_one(df).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 6])
def test_links_of_dense_and_sparse_buckets(radius):
    rng = np.random.default_rng(radius)
    near = rng.integers(0, 2**63, 1).astype(np.uint64) ^ (np.uint64(1) << rng.integers(0, 12, (900, 3)).astype(np.uint64)).sum(1).astype(np.uint64)
    far = rng.integers(0, 2**63, 900).astype(np.uint64)
    prints = np.unique(np.concatenate([near, far, far ^ np.uint64(1 << 40)]))
    bucket = np.sort(rng.choice([1, 1, 1, 2, 5, *range(100, 400)], len(prints)))
    a, b = simhash.linked(bucket, prints, radius)
    where = {int(p): i for i, p in enumerate(prints)}
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bucket[i] == bucket[j] and (int(prints[i]) ^ int(prints[j])).bit_count() <= radius:
                parent[find(i)] = find(j)
    wanted = [find(i) for i in range(len(prints))]
    parent = list(range(len(prints)))
    for x, y in zip(a, b):
        parent[find(where[int(x)])] = find(where[int(y)])
    pairs = {(w, find(i)) for i, w in enumerate(wanted)}
    assert len(pairs) == len(set(wanted)) == len({p for _, p in pairs})


def test_masks_leave_one_that_agrees():
    random.seed(1)
    for _ in range(2000):
        flips = sum(1 << b for b in random.sample(range(64), 4))
        assert any(flips & m == 0 for m in simhash.masks(4))


def test_tiles_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = random.Random(3)
    prints = list({sum(1 << b for b in rng.sample(range(20), 4)) for _ in range(150)} | {rng.getrandbits(63) for _ in range(50)})
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id long, fingerprint long")
    got = {r["fingerprint"]: r["component_id"] for r in simhash.classes(df).collect()}
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert got == {p: find(i) for i, p in enumerate(prints)}


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (-5, -9)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(got)
    assert got == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1100)} | {-5: -9, -9: -9}


def test_a_hub_is_divided(spark, monkeypatch):
    """The neighbours of one node with most edges meet it in a join that Spark splits."""
    plans = []
    real = graph.materialize

    def recorded(df, name):
        if name == "large_stars":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(graph, "materialize", recorded)
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        n = F.col("id")
        hub = spark.range(40_000).select(F.lit(0).cast("long").alias("a"), (n + 1).alias("b"))
        edges = hub.unionByName(spark.range(4000).select((n + 50_000).alias("a"), (n * 7 + 60_000).alias("b")))
        rows = graph.components(edges.repartition(12))
        assert rows.filter("root = 0").count() == 40_001
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in plans[0]
