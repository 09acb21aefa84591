from __future__ import annotations

import numpy as np
import pytest

from tallywright.llm import counts
from tallywright.llm.queries import op7_token_counts
from tallywright.llm.tokens import encoder


def slow(text):
    return len(encoder().plain.encode(text or "", add_special_tokens=False).ids)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = op7_token_counts(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in rows) == sorted((r["doc_id"], slow(r["text"])) for r in docs)


@pytest.mark.parametrize("block", [1, 3, 1000, 1 << 16])
def test_odd_texts(spark, block):
    texts = [None, "", " ", "<|endoftext|>", "é😀", "word " * 3000, "", "x", None]
    rows = [(i, t, 1, "d", 2) for i, t in enumerate(texts)] + [(7, "x", 1, "d", 2), (None, "a b", 1, "d", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file int, data string, place int").coalesce(2)
    got = counts.document_token_counts(df, block=block, span=2000).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((r[0], slow(r[1])) for r in rows), key=str)
    assert counts.document_token_counts(df.limit(0), block=block).count() == 0
    assert got and counts.document_token_counts(df, block=block).schema["doc_id"].dataType.simpleString() == "bigint"


def test_ids_of_any_type(spark):
    rows = [("a = b\n", "x y"), ("", "x"), (None, ""), ("=", None), ("7 =8", "word"), ("P\u0100 \xc4", "more")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = counts.document_token_counts(df, block=2).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, slow(t)) for i, t in rows), key=str)


def test_files_are_flat(spark, tmp_path):
    """Ids and separators, and not a byte else, in the order that lies beside them."""
    texts = ["one two", None, "three", "<|endoftext|>", ""]
    df = spark.createDataFrame([(i * 10, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    counts.write_token_files(df, str(tmp_path / "t"))
    end, width = counts.separator_of()
    file, = (tmp_path / "t").glob("kind=tokens/file=0/*.txt")
    want = [i for t in texts for i in [*encoder().ids(t, special=False), end]]
    assert np.fromfile(file, f"<u{width}").tolist() == want
    order = counts.read_order(spark, str(tmp_path / "t")).orderBy("place").collect()
    assert [tuple(r) for r in order] == [(0, i, str(i * 10)) for i in range(5)]


def test_width_of_ids(spark, tmp_path):
    """Two bytes or four, and no id is cut to fit."""
    assert [counts.id_width(n, e) for n, e in ((50_000, 2), (50_257, 50_256), (65_536, 0x3061), (65_537, 9), (70_000, 69_999))] == [2, 2, 4, 4, 4]
    with pytest.raises(ValueError):
        counts.id_bytes(np.array([70_000], np.uint32), 2)
    with pytest.raises(ValueError):
        counts.id_width(1 << 40, 0)
    ids = np.array([70_000, 4_464, 69_999, 70_000, 4_464], np.uint32)  # 70,000 and 4,464 have the same low bytes
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a").write_bytes(counts.id_bytes(ids, 4))
    rows = counts.token_counts(spark, str(tmp_path / "w"), end=4_464, width=4, block=2, span=8).collect()
    assert sorted((r["place"], r["n_tokens"], r["ended"]) for r in rows) == [(0, 1, True), (1, 2, True)]
    (tmp_path / "w" / "b").write_bytes(b"\x01\x00\x02")
    with pytest.raises(Exception, match="ends within an id"):
        counts.token_counts(spark, str(tmp_path / "w"), end=1, width=2).collect()


@pytest.mark.parametrize("block, chunk, span", [(1, 2, 1), (4, 3, 24), (7, 1000, 1 << 25), (64, 1, 300)])
def test_flat_files(spark, tmp_path, monkeypatch, block, chunk, span):
    """Files that begin, end and go on with separators or without any, divided among tasks."""
    monkeypatch.setattr(counts, "CHUNK", chunk)
    rng = np.random.default_rng(block)
    files = {
        "a": rng.integers(0, 4, 500), "b": np.full(90, 0), "c": rng.integers(1, 9, 77), "d": np.array([0, 5, 5, 0]),
        "e": np.array([], int), "f": np.array([5]), "g": np.concatenate([rng.integers(1, 9, 200), [0], rng.integers(1, 9, 200)]),
    }
    for name, ids in files.items():
        ids.astype("<u2").tofile(tmp_path / name)
    rows = counts.token_counts(spark, str(tmp_path), end=0, block=block, span=span).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["place"])):
        got.setdefault(r["file"][-1], []).append((r["place"], r["n_tokens"], r["ended"]))
    wanted = {}
    for name, ids in files.items():
        runs = "".join("|" if x == 0 else "." for x in ids).split("|")
        docs = [(i, len(r), i < len(runs) - 1) for i, r in enumerate(runs)]
        wanted[name] = docs if docs[-1][1] else docs[:-1]
    assert got == {k: v for k, v in wanted.items() if v}
