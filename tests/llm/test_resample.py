from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywright.llm import resample
from tallywright.llm.queries import op13_resample

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def runs(text, buckets=10_000):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def slow(docs, target, percent=5, seed=42, least=20, buckets=10_000):
    """{place of the row: (n_features, weight, score, rank)} of rows (doc_id, text)."""
    own, goal = Counter(), Counter()
    for _, text in docs:
        own.update(runs(text, buckets))
    for text in target:
        goal.update(runs(text, buckets))
    s_all, t_all = sum(own.values()), sum(goal.values())
    gain = {
        b: math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((own[b] + 1) * (t_all + buckets)))) for b in range(buckets)
    }
    out = []
    for doc_id, text in docs:
        found = runs(text, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [i for i, (_, text) in enumerate(docs) if len(words(text)) >= least]
    order = sorted(able, key=lambda i: (-out[i][2], docs[i][0] is None, docs[i][0], out[i][0]))
    for rank, i in enumerate(order[: percent * len(able) // 100]):
        out[i][3] = rank + 1
    return [tuple(o) for o in out]


TEXTS = [
    None, "", " .-", "Word", "two WORDS", "a b c d", "É é ÀB İ", "x" * 3000, "a " * 500, "the cat sat on the mat " * 40, "\x00a\x00b", "...tail", "head...", "über-straße 7"
]


def as_rows(found):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found), key=str)


@pytest.mark.parametrize("slice_bytes", [1 << 22, 64, 1])
def test_features(slice_bytes, monkeypatch):
    """Buckets are those of CRC-32 over the spelt runs, wherever long texts are cut."""
    monkeypatch.setattr(resample, "SLICE", slice_bytes)
    texts = [*TEXTS, " lead and trail ", "one two three four five six seven eight nine ten " * 20, "ab" * 200 + " q r " + "cd" * 300, "." * 500 + "z"]
    array = pa.array(texts, pa.string())
    got = [Counter() for _ in texts]
    for first, _, some, carried in resample._slices(array):
        found = resample.features(some, carried)
        for row, one, two, three, fresh in zip(found.row, found.one, found.two, found.three, found.fresh):
            got[first + row].update([b for b, real in ((one, fresh), (two, fresh and two >= 0), (three, three >= 0)) if real])
    assert got == [Counter(runs(t)) for t in texts]


def test_joined_crc():
    parts = [(b"", b"a"), (b"abc", b""), (b"x" * 70, b"y" * 3000), (b"a ", b"\xc3\xa9")]
    first, second = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    assert resample.joined_crc(first, second, np.array([len(b) for _, b in parts])).tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_brute_force(spark):
    rows = [(i, t, "own", 1.5) for i, t in enumerate(TEXTS * 30)]
    rows += [(None, "no id but words enough " * 5, "own", 1.5), (2000, "again " * 25, "own", 1.5), (2000, "again " * 25, "own", 1.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, score double").repartition(5)
    target = ["the cat", "a b", None, "über alles", "the mat again"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resample.ranked(resample.scored(docs, goal), percent=40).collect()
    pairs = [(r[0], r[1]) for r in rows]
    want = [(i, *w) for (i, _), w in zip(pairs, slow(pairs, target, percent=40))]
    assert as_rows(found) == sorted(want, key=str)
    drawn = resample.resample(docs, goal, percent=40)
    assert drawn.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["row"]) for r in drawn.collect() if r["doc_id"] is not None) == sorted(
        (i, t, "own") for (i, t), w in zip(pairs, want) if w[-1] and i is not None
    )


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert as_rows(resample.ranked(resample.scored(docs, none), percent=100).collect()) == [(1, *slow([(1, "a b c " * 20)], [], percent=100)[0])]
    assert resample.ranked(resample.scored(docs.limit(0), none)).collect() == []
    assert resample.resample(docs.limit(0), docs).collect() == []
    assert resample.resample(docs, none).collect() == []


def test_counts_do_not_follow_layout(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, many = (sorted(map(tuple, resample.bucket_counts(docs.repartition(n)).collect())) for n in (1, 7))
    assert one == many and sum(n for _, n in one) == sum(len(runs(r["text"])) for r in docs.select("text").collect())


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = sorted(((i, *w) for (i, _), w in zip(docs, slow(docs, target))), key=str)
    found = op13_resample(spark, sf_dir)
    assert as_rows(found.collect()) == want and any(w[-1] for w in want)
    assert {f.dataType.simpleString() for f in found.schema} == {"bigint"}
    assert found.filter(F.col("rank").isNotNull()).count() == max(w[-1] or 0 for w in want)
