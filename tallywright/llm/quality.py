"""Quality statistics of texts, and decision lists learned from labelled ones."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.text import let, lines, trim, words
from tallywright.sources.scratch import materialize

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 3

# What rules may test.
MEASURES: dict[str, str] = {
    "words": "double(n_words)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_100_words": "100 * n_symbols / greatest(n_words, 1)",
    "repeated_per_100_words": "100 * n_repeat_words / greatest(n_words, 1)",
    "dup_lines_per_100_words": "100 * n_dup_lines / greatest(n_words, 1)",
}
Thresholds = Mapping[str, Sequence[float]]
# The thresholds are values of the growing rows themselves: these quantiles of a measure over the
# bad ones and over the good ones. Ties and equal quantiles leave fewer.
QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)
# Digits to which values are cut before they are counted, so that their number is bounded.
DIGITS = 4
# Of three parts of the labelled rows, by the hash of the key, two grow rules and one prunes them.
PARTS = 3


def _repeated_words(word: Column) -> Column:
    """Words in windows of three that are found twice or more, each word once."""
    last = F.size(word) - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(WINDOW)])
    )

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(
            ordered,
            lambda s: F.filter(
                s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            ),
        )
        places = F.flatten(F.transform(twice, lambda x: F.array(*[x["i"] + k for k in range(WINDOW)])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(F.size(F.array_distinct(places)))

    return F.when(last < 1, F.lit(0)).otherwise(let(hashes, covered))


def with_statistics(docs: DataFrame, text: str = "text", output: str = "stats") -> DataFrame:
    """Adds a struct of five whole-text counts (long): words; code points in words;
    characters of ``#*$%&|<>``; lines with a word that equal an earlier line; words in
    three-word windows found twice or more. A null text has none of each."""
    whole = F.coalesce(F.col(text), F.lit(""))
    full = F.filter(lines(whole), lambda line: trim(line) != "")
    inner = [
        F.size("word").alias("n_words"),
        F.char_length(F.array_join("word", "")).alias("word_chars"),
        F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        let(full, lambda a: F.size(a) - F.size(F.array_distinct(a))).alias("n_dup_lines"),
        _repeated_words(F.col("word")).alias("n_repeat_words"),
    ]
    kind = ", ".join(f"{c}: bigint" for c in STATISTICS)
    return (
        docs.select("*", words(F.col(text)).alias("word"))
        .withColumn(output, F.struct(*inner).cast(f"struct<{kind}>"))
        .drop("word")
    )


def base_failed(stats: str = "stats") -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    n = F.col(f"{stats}.n_words")
    return (n < 50) | (100 * F.col(f"{stats}.n_repeat_words") > 50 * n)


def measures(stats: str = "stats") -> dict[str, Column]:
    inner = {c: f"{stats}.{c}" for c in STATISTICS}

    def of(sql: str) -> Column:
        for c, path in inner.items():
            sql = sql.replace(c, path)
        return F.expr(sql)

    return {name: of(sql) for name, sql in MEASURES.items()}


@dataclass(frozen=True)
class Test:
    """``measure >= threshold``, or ``<`` where ``above`` is false."""

    measure: str
    threshold: float
    above: bool

    def column(self, stats: str = "stats") -> Column:
        value = measures(stats)[self.measure]
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.above else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class Cell:
    """Labelled rows that no test can tell apart: bins by measure, part, and their numbers."""

    bins: dict[str, int]
    grows: bool
    bad: int
    good: int

    def meets(self, test: Test, thresholds: Thresholds) -> bool:
        above = self.bins[test.measure] > thresholds[test.measure].index(test.threshold)
        return above == test.above


def labelled_measures(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """A stored table of the measures, ``grows`` and ``bad`` (0 or 1) of every labelled row of
    (doc_id, stats) that meets the base rules. A doc_id labelled twice counts as bad
    if one label is 0; null labels and ids count for nothing."""
    label = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    grows = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) > 0
    rows = stats.filter(~base_failed()).join(label, "doc_id")
    values = [c.alias(n) for n, c in measures().items()]
    return materialize(rows.select(*values, grows.alias("grows"), (F.col("quality") == 0).cast("long").alias("bad")), "labelled")


def _cut(value: Column) -> Column:
    """A value that is not negative without what is beyond ``DIGITS`` digits, so no larger."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(value)) - (DIGITS - 1))
    near = F.floor(value / unit) * unit
    return F.when(value > 0, F.least(near, value)).otherwise(F.lit(0.0))


def quantile_thresholds(rows: DataFrame, quantiles: Sequence[float] = QUANTILES) -> dict[str, tuple[float, ...]]:
    """The quantiles of each measure over the bad growing rows and over the good ones, each
    once, ascending: the smallest value that so large a part of them does not exceed.

    Exact, of values cut to ``DIGITS`` digits: they are counted in each task before the
    shuffle and added up in order, of which no task has more than there are such values.
    """
    each = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), _cut(F.col(m)).alias("value")) for m in MEASURES]))
    counts = rows.filter("grows").select("bad", each).groupBy("measure", "bad", "value").agg(F.count("*").alias("n"))
    side = Window.partitionBy("measure", "bad")
    summed = counts.withColumns(
        {"upto": F.sum("n").over(side.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("n").over(side)}
    )
    rank = [F.greatest(F.ceil(F.lit(q) * F.col("total")), F.lit(1)) for q in quantiles]
    at_one = F.exists(F.array(*rank), lambda r: (r > F.col("upto") - F.col("n")) & (r <= F.col("upto")))
    found = summed.filter(at_one).select("measure", "value").distinct().collect()
    return {m: tuple(sorted(r["value"] for r in found if r["measure"] == m)) for m in MEASURES}


def labelled_cells(rows: DataFrame, thresholds: Thresholds) -> list[Cell]:
    """Counts of good and bad rows by bins of all measures, over all of ``labelled_measures``.

    Their number is bounded by the thresholds, whatever the number of rows: at most the
    product of the bins, 19 for each of five measures where no quantiles are equal, in two
    parts. Of a million labelled rows some ten thousand cells are to be expected.
    """
    bins = {m: sum(((F.col(m) >= t).cast("int") for t in thresholds[m]), F.lit(0)) for m in MEASURES}
    counted = (
        rows.select(*[c.alias(n) for n, c in bins.items()], "grows", "bad")
        .groupBy(*bins, "grows")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
        .toArrow()
        .to_pylist()
    )
    # In an order that does not follow from the partitions.
    counted.sort(key=lambda r: [*(r[n] for n in bins), r["grows"]])
    return [Cell({n: r[n] for n in bins}, r["grows"], r["bad"], r["good"]) for r in counted]


class _Rows:
    """Cells as arrays: a bin of each by measure, and their numbers of bad and good rows."""

    def __init__(self, cells: Sequence[Cell], thresholds: Thresholds) -> None:
        self.thresholds = thresholds
        self.bins = {m: np.array([c.bins[m] for c in cells], np.int64) for m in MEASURES}
        self.bad = np.array([c.bad for c in cells], np.int64)
        self.good = np.array([c.good for c in cells], np.int64)

    def meet(self, rule: Sequence[Test]) -> np.ndarray:
        met = np.ones(len(self.bad), bool)
        for test in rule:
            met &= (self.bins[test.measure] > self.thresholds[test.measure].index(test.threshold)) == test.above
        return met

    def totals(self, where: np.ndarray) -> tuple[int, int]:
        return int(self.bad[where].sum()), int(self.good[where].sum())


def _grow(rows: _Rows, here: np.ndarray) -> list[Test]:
    """Adds the test with the largest information gain until no good row is left or
    no test gains. Of equal tests the one that covers less is taken."""
    rule: list[Test] = []
    while True:
        bad, good = rows.totals(here)
        if not bad or not good:
            return rule
        before = math.log2(bad / (bad + good))
        found = []
        for name in MEASURES:
            size = len(rows.thresholds[name]) + 1
            bins = rows.bins[name][here]
            below_bad, below_good = (np.bincount(bins, x[here], size).cumsum().tolist() for x in (rows.bad, rows.good))
            for place, threshold in enumerate(rows.thresholds[name]):
                for above in (True, False):
                    p, n = below_bad[place], below_good[place]
                    if above:
                        p, n = bad - p, good - n
                    gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                    found.append((round(gain, 9), place if above else -place, Test(name, threshold, above)))
        gain, _, test = max(found, key=lambda x: x[:2])
        if gain <= 0:
            return rule
        rule.append(test)
        here = here & rows.meet([test])


def _prune(rule: list[Test], rows: _Rows, here: np.ndarray) -> list[Test]:
    """The shortest beginning of the rule whose share of bad rows, on rows that did not
    grow it, is the largest."""

    def worth(size: int) -> float:
        p, n = rows.totals(here & rows.meet(rule[:size]))
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda size: (worth(size), -size))] if rule else rule


def _by_chance(bad: int, good: int, share: float) -> float:
    """A bound of the probability that of ``bad + good`` rows ``bad`` or more are bad, where
    ``share`` of all rows are: exact if none is good, else that of Chernoff."""
    n = bad + good
    if not n or share <= 0 or bad <= share * n:
        return 1.0
    distance = bad * math.log(bad / n / share) + (good * math.log(good / n / (1 - share)) if good else 0.0)
    return math.exp(-distance)


def learn(cells: list[Cell], thresholds: Thresholds, precision: float = 0.9, chance: float = 0.05) -> list[list[Test]]:
    """Sequential covering: an ordered list of rules that reject.

    Each rule is grown on two thirds of the labelled rows and pruned on the rest. It is
    taken if at least ``precision`` of the rows of the rest under it are bad, and so many that
    by chance, at the share of bad rows left there, any rule would be taken with a
    probability of ``chance`` at most: the t-th one tried has ``chance / t(t+1)`` of it. Rows
    under it leave, and the next is grown. What a rule covers that is not taken grows no
    other, and the search goes on with the remaining rows until no rule grows. Without
    labelled rows of both kinds there is no rule.
    """
    rules: list[list[Test]] = []
    rows, tried = _Rows(cells, thresholds), 0
    growing = np.array([c.grows for c in cells], bool)
    held = ~growing
    while grown := _grow(rows, growing):
        tried += 1
        rule = _prune(grown, rows, held)
        met = rows.meet(rule)
        bad, good = rows.totals(held & met)
        left = rows.totals(held)
        likely = _by_chance(bad, good, left[0] / max(1, sum(left)))
        if bad >= precision * (bad + good) and likely <= chance / (tried * (tried + 1)):
            rules.append(rule)
            growing, held = growing & ~met, held & ~met
        else:
            growing = growing & ~rows.meet(grown)
    return rules


def verdict(rules: Sequence[Sequence[Test]], stats: str = "stats") -> Column:
    """True where no rule rejects, as one ordered conditional expression."""
    kept = F.when(base_failed(stats), F.lit(False))
    for rule in rules:
        all_of = F.lit(True)
        for test in rule:
            all_of = all_of & test.column(stats)
        kept = kept.when(all_of, F.lit(False))
    return kept.otherwise(F.lit(True))


def fit(
    stats: DataFrame,
    labels: DataFrame,
    quantiles: Sequence[float] = QUANTILES,
    precision: float = 0.9,
    chance: float = 0.05,
) -> list[list[Test]]:
    """The decision list learned from a stored table (doc_id, stats) and labels (doc_id, quality)."""
    rows = labelled_measures(stats, labels)
    thresholds = quantile_thresholds(rows, quantiles)
    return learn(labelled_cells(rows, thresholds), thresholds, precision, chance)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that meet the base rules and the decision list learned from
    the labelled ones among them, with all their columns. A null text has no words and goes.
    Texts are read once: the statistics are stored beside the rows."""
    rows = docs.select(F.struct("*").alias("row"), docs["doc_id"], docs["text"])
    stored = materialize(with_statistics(rows).select("row", "stats"), "statistics")
    rules = fit(stored.select("row.doc_id", "stats"), labels)
    return stored.filter(verdict(rules)).select("row.*")
