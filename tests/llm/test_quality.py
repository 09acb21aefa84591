from __future__ import annotations

import itertools
import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tallywright.llm import quality
from tallywright.llm.queries import op2_quality_rules
from tallywright.sources.scratch import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    w = WORD.findall(text)
    rows = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(rows) - len(set(rows)), len(covered))


def test_statistics_and_base_of_the_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        stats = slow(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.STATISTICS) == stats
        assert r["base_failed"] == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert not (r["base_failed"] and r["kept"])


def test_odd_texts(spark):
    texts = [
        None, "", " \n\t\x0b", "a", "a b", "a b c", "a b c a b c", "x x x x", "x x x x x\n", "é É y # $ &|<>%*\n\nq\nq\n q\nq",
        "a b c d\na b c d\n\na b c d", "😀 ok".encode("utf-16", "surrogatepass").decode("utf-16"),
        " ".join(f"w{i % 1000}" for i in range(30_000)), "z" * 200_000,
    ]
    df = spark.createDataFrame([(i, t, "w", 5) for i, t in enumerate(texts)], "doc_id long, text string, words string, n_words int")
    got = {r["doc_id"]: tuple(r["stats"]) for r in quality.with_statistics(df).collect()}
    assert got == {i: slow(t) for i, t in enumerate(texts)}


# Bins of the cells below.
THRESHOLDS = {
    "words": (100, 200, 500, 1000, 5000, 20000),
    "chars_per_word": (2, 3, 3.5, 4, 6, 7, 8, 10, 12),
    "symbols_per_100_words": (1, 2, 5, 10, 20, 50, 100, 200),
    "repeated_per_100_words": (5, 10, 20, 30, 40),
    "dup_lines_per_100_words": (0.5, 1, 2, 5, 10),
}


def cells(rows):
    bins = {m: 0 for m in quality.MEASURES}
    return [quality.Cell(bins | b, g, bad, good) for b, g, bad, good in rows]


def test_rules_are_ordered_conjunctions():
    """Bad: many symbols; and long words only where texts repeat little."""
    data = []
    for grows in (True, False):
        data += [({"symbols_per_100_words": 6}, grows, 50, 0), ({}, grows, 0, 500), ({"chars_per_word": 8}, grows, 40, 1)]
        data += [({"chars_per_word": 8, "repeated_per_100_words": 3}, grows, 0, 60)]
    rules = quality.learn(cells(data), THRESHOLDS)
    assert len(rules) == 2 and all(rules)
    kept = [c for c in cells(data) if not any(all(c.meets(t, THRESHOLDS) for t in rule) for rule in rules)]
    assert sum(c.bad for c in kept) == 0 and sum(c.good for c in kept) == 1120


def test_a_rule_covers_no_more_than_it_needs():
    data = [({"symbols_per_100_words": 6}, g, 50, 0) for g in (True, False)] + [({}, g, 0, 500) for g in (True, False)]
    assert [[str(t) for t in rule] for rule in quality.learn(cells(data), THRESHOLDS)] == [["symbols_per_100_words >= 50"]]


def test_no_rule_without_both_kinds_or_from_noise():
    assert quality.learn([], THRESHOLDS) == []
    assert quality.learn(cells([({}, True, 9, 0), ({}, False, 0, 9)]), THRESHOLDS) == []
    assert quality.learn(cells([({"words": 2}, g, 10, 90) for g in (True, False)]), THRESHOLDS) == []


def test_held_out_labels(spark):
    """Learned from the labelled half, tested on the other."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stats = materialize(quality.with_statistics(docs).select("doc_id", "stats"), "statistics")
    rules = quality.fit(stats, labels.filter("doc_id % 2 = 0"))
    assert rules
    rest = stats.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter(~quality.base_failed())
    r = rest.select((F.col("quality") == 0).alias("bad"), quality.verdict(rules).alias("kept")).toPandas()
    assert ((~r["kept"]) == r["bad"]).mean() > 0.97


def test_stage_keeps_columns_and_good_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good, "a", 1), (2, "short", "b", 2), (3, None, "c", 3), (None, good, "d", 4), (1, good, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, stats string, row int")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, quality int")
    out = quality.keep_good(df, labels)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[3], rows[4]], key=str)
    assert quality.keep_good(df.limit(0), labels.limit(0)).count() == 0


def test_few_held_out_labels(spark):
    """As on sf0.1, where few bad labels are left."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stats = materialize(quality.with_statistics(docs).select("doc_id", "stats"), "statistics")
    rules = quality.fit(stats, labels.filter("doc_id % 2 = 0"))
    assert rules
    rest = stats.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter(~quality.base_failed())
    r = rest.select((F.col("quality") == 0).alias("bad"), quality.verdict(rules).alias("kept")).toPandas()
    assert ((~r["kept"]) == r["bad"]).mean() > 0.97


def test_rare_kinds_are_learned_behind_a_rule_that_fails():
    """Short words are bad only where rules grow, so this rule fails; many symbols are always bad, but rare."""
    data = [({"chars_per_word": 0}, True, 60, 0), ({"chars_per_word": 0}, False, 0, 30), ({"chars_per_word": 4}, True, 0, 900)]
    data += [({"chars_per_word": 4}, False, 0, 450), ({"chars_per_word": 4, "symbols_per_100_words": 6}, True, 6, 0)]
    data += [({"chars_per_word": 4, "symbols_per_100_words": 6}, False, 3, 0)]
    rules = quality.learn(cells(data), THRESHOLDS)
    assert [[str(t) for t in rule] for rule in rules] == [["symbols_per_100_words >= 50"]]


def test_more_than_twenty_kinds_are_learned():
    """Bad and good by turns along three measures, so that each kind needs a rule of its own."""
    sizes = {"words": 7, "chars_per_word": 10, "symbols_per_100_words": 9}
    kinds = [dict(zip(sizes, at)) for at in itertools.product(*map(range, sizes.values()))]
    data = [(k, g, *((0, 900) if any(i % 2 for i in k.values()) else (300, 0))) for k in kinds for g in (True, False)]
    rules = quality.learn(cells(data), THRESHOLDS)
    assert len(rules) > 20
    for c in cells(data):
        assert any(all(c.meets(t, THRESHOLDS) for t in rule) for rule in rules) == (c.bad > 0)


def statistics(spark, rows):
    """A stored table (doc_id, stats) of given statistics."""
    kind = ", ".join(f"{c}: bigint" for c in quality.STATISTICS)
    df = spark.createDataFrame(rows, f"doc_id long, stats struct<{kind}>")
    return materialize(df, "given")


def test_thresholds_come_from_the_labelled_rows(spark):
    """Kinds that lie close together are told apart: 5.0 and 5.8 letters a word."""
    rows = [(i, (1000, 5000 if i < 400 else 5800, 0, 0, 0)) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i >= 400)) for i in range(1200)], "doc_id long, quality int")
    rules = quality.fit(statistics(spark, rows), labels)
    assert [[str(t) for t in rule] for rule in rules] == [["chars_per_word < 5.8"]]


def test_quantiles_are_exact(spark):
    rows = [((i * 7919) % 1000 / 8.0, i % 3 == 0, int(i % 5 == 0)) for i in range(1000)]
    frame = spark.createDataFrame([(v, v, v, v, v, g, b) for v, g, b in rows], [*quality.MEASURES, "grows", "bad"])
    for parts in (1, 5):
        found = quality.quantile_thresholds(frame.repartition(parts), (0.0, 0.1, 0.5, 1.0))
        want = set()
        for side in (0, 1):
            values = sorted(v for v, g, b in rows if g and b == side)
            want |= {values[max(math.ceil(q * len(values)), 1) - 1] for q in (0.0, 0.1, 0.5, 1.0)}
        cut = sorted({float(f"{math.floor(v / 10 ** (math.floor(math.log10(v)) - 3) + 1e-9) * 10.0 ** (math.floor(math.log10(v)) - 3):.6g}") if v else 0.0 for v in want})
        assert all(len(t) == len(cut) and all(abs(a - b) <= 1e-9 * max(1, b) for a, b in zip(t, cut)) for t in found.values())
    assert quality.quantile_thresholds(frame.limit(0)) == {m: () for m in quality.MEASURES}


def kept_of(rules, stats):
    """The verdict of a decision list in plain Python."""
    n, chars, symbols, dup, repeated = stats
    if n < 50 or 100 * repeated > 50 * n:
        return False
    words = max(n, 1)
    values = {
        "words": float(n), "chars_per_word": chars / words, "symbols_per_100_words": 100 * symbols / words,
        "repeated_per_100_words": 100 * repeated / words, "dup_lines_per_100_words": 100 * dup / words,
    }
    return not any(all((values[t.measure] >= t.threshold) == t.above for t in rule) for rule in rules)


def test_verdicts_of_the_query(spark):
    """Each ``kept`` of a table on which rules are learned, from the rules in plain Python."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stats = materialize(quality.with_statistics(docs).select("doc_id", "stats"), "statistics")
    rules = quality.fit(stats, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules
    want = {r["doc_id"]: kept_of(rules, slow(r["text"])) for r in docs.collect()}
    assert {r["doc_id"]: r["kept"] for r in op2_quality_rules(spark, folder).collect()} == want
    assert 0 < sum(not k for k in want.values()) < len(want) / 2
