"""URL filters: prefix rules, and exact list membership by a cascade of Bloom filters."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = 64
# Bits of the levels that one task holds at a time: 32 MB. A list that needs more is dealt by
# the hash of its keys into slices, each with a cascade of its own.
MOST_BITS = 1 << 28
# Keys of a level up to which its bits weigh little, and the share of others that it then lets through.
SMALL, SMALL_RATE = 1 << 16, 1 / 256
# The share that levels of more keys let through; the first one's follows from the two sides.
RATE = 0.5


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty for a null or where there is no ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or the end; empty as the host is."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path of the url starts with its own."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def parse_rules(text: str) -> list[Rule]:
    """Rules such as ``block example.com/en/``, one to a line, from the longest."""
    rules = []
    for line in filter(None, map(str.strip, text.splitlines())):
        verdict, place = line.split()
        host, slash, path = place.partition("/")
        rules.append(Rule(verdict, host, slash + path))
    return sorted(rules, key=lambda r: (-len(r.name), r.name))


def rule_name(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The name of the longest rule that fits, else null."""
    named = F.lit(None).cast("string")
    for rule in reversed(rules):
        named = F.when(rule.fits(host, path), F.lit(rule.name)).otherwise(named)
    return named


def rule_verdict(rules: Sequence[Rule], name: Column) -> Column:
    """The verdict of the rule of this name, else null."""
    verdict = F.lit(None).cast("string")
    for rule in rules:
        verdict = F.when(name == rule.name, F.lit(rule.verdict)).otherwise(verdict)
    return verdict


def _places(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(i), key), F.lit(bits)) for i in range(hashes)]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its words are an array<long> of a one-row stored table."""

    number: int
    hashes: int
    bits: int
    words: DataFrame

    def holds(self, key: Column) -> Column:
        """True for each key that was put in, and for some others."""
        words = self.words.select("words").scalar()
        found = F.lit(True)
        for place in _places(key, self.number, self.hashes, self.bits):
            word = F.get(words, F.floor(place / WORD).cast("int"))
            found = found & (F.getbit(word, (place % WORD).cast("int")) == 1)
        return found


def _size(count: int, rate: float) -> int:
    """Bits of a filter of so many keys."""
    return WORD * max(1, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / WORD))


def _build(keys: DataFrame, count: int, number: int, rate: float) -> Level:
    """A filter of the (key) rows, its bits combined in each task before the shuffle."""
    hashes, bits = max(1, round(-math.log2(rate))), _size(count, rate)
    place = F.explode(F.array(*_places(F.col("key"), number, hashes, bits))).alias("place")
    words = (
        keys.select(place)
        .groupBy(F.floor(F.col("place") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(place % {WORD} as int))")).alias("set"))
    )
    every = keys.sparkSession.range(bits // WORD).select(F.col("id").cast("int").alias("word"))
    filled = every.join(words, "word", "left").select("word", F.coalesce("set", F.lit(0).cast("long")).alias("set"))
    row = filled.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("all"))
    return Level(number, hashes, bits, materialize(row.select(F.col("all.set").alias("words")), "bloom"))


def _rate(number: int, count: int, others: int) -> float:
    """The share of ``others`` that level ``number`` of ``count`` keys may let through.

    Each level costs two passes over what is left, each halving of its rate a bit and a half
    for each of its keys. Half is the cheapest where keys are many, but for the first level:
    of it as many of the others may pass as make the second level little larger than itself.
    """
    if count <= SMALL:
        return SMALL_RATE
    return min(RATE, count * math.sqrt(0.5) / max(others, 1)) if number == 1 else RATE


def _levels(listed: DataFrame, others: DataFrame) -> list[Level]:
    levels: list[Level] = []
    now, other = listed, others
    count, rest = now.count(), other.count()
    while count:
        number = len(levels) + 1
        levels.append(_build(now, count, number, _rate(number, count, rest)))
        passed = materialize(other.filter(levels[-1].holds(F.col("key"))), "passed")
        now, other, count, rest = passed, now, passed.count(), count
    return levels


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (key).

    The first level holds the listed keys, the second those other keys of the universe
    that the first lets through, the third the listed ones that the second lets
    through, and so on until nothing is. A key belongs by the first level that denies
    it: to the list if that level is even, else not; one that no level denies belongs to
    what the last holds. Each level has fewer keys, so there are about as many as the
    logarithm of the list.

    The list may have keys beyond the universe; those are ignored. Null keys are in
    neither. Where the levels need more than ``most_bits`` together, both sides are dealt
    by the hash of the key into slices that need no more, each with levels of its own.
    """

    def __init__(self, universe: DataFrame, listed: DataFrame, most_bits: int = MOST_BITS) -> None:
        known = universe.select("key").filter("key is not null").distinct()
        marked = known.join(listed.select("key").distinct().withColumn("inside", F.lit(True)), "key", "left")
        keys = materialize(marked.select("key", F.col("inside").isNotNull().alias("inside")), "keys")
        sides = keys.agg(F.count_if("inside").alias("listed"), F.count("*").alias("all")).first()
        count, others = sides["listed"], sides["all"] - sides["listed"]
        # The later levels together need no more than some four bits for each listed key.
        self.slices = max(1, math.ceil((_size(count, _rate(1, count, others)) + 4 * count) / most_bits)) if count else 1
        self.cascades = []
        for number in range(self.slices):
            some = keys.filter(self.slice_of(F.col("key")) == number) if self.slices > 1 else keys
            self.cascades.append(_levels(some.filter("inside").select("key"), some.filter("not inside").select("key")))

    def slice_of(self, key: Column) -> Column:
        """The slice that knows a key; a null is in the first."""
        return F.coalesce(F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(self.slices)).cast("int"), F.lit(0))

    def _by(self, levels: list[Level], key: Column) -> Column:
        answer = F.lit(len(levels) % 2 == 1)
        for level in reversed(levels):
            answer = F.when(~level.holds(key), F.lit(level.number % 2 == 0)).otherwise(answer)
        return F.when(key.isNull(), F.lit(False)).otherwise(answer)

    def inside(self, key: Column) -> Column:
        """True where the key is listed; for a key outside the universe either, for a null false.
        A task holds the levels of all slices."""
        answer = self._by(self.cascades[0], key)
        for number, levels in enumerate(self.cascades[1:], 1):
            answer = F.when(self.slice_of(key) == number, self._by(levels, key)).otherwise(answer)
        return answer

    def mark(self, df: DataFrame, key: str, output: str) -> DataFrame:
        """``df`` with a column that tells whether its key is listed. Each slice marks the rows
        of its own keys where they are, in a scan of its own, so a task holds one at a time."""
        found = None
        for number, levels in enumerate(self.cascades):
            rows = df.filter(self.slice_of(F.col(key)) == number) if self.slices > 1 else df
            some = rows.withColumn(output, self._by(levels, F.col(key)))
            found = some if found is None else found.unionByName(some)
        return found
