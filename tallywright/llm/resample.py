"""Importance resampling: documents drawn by how much their n-grams are those of a target."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.operators.ranking import numbered
from tallywright.sources.scratch import materialize

BUCKETS = 10_000
# Separators once a text is lower-cased: ASCII but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_IS_SEPARATOR = np.array([c < 0x80 and not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A) for c in range(256)])
# Bytes of text whose features are formed together; a longer text is cut between words.
SLICE = 1 << 22
MIN_WORDS, PERCENT, SEED = 20, 5, 42
# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _times(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of 32 bits times a matrix of 32 columns over GF(2)."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


@functools.lru_cache(maxsize=64)
def _doubled(power: int) -> np.ndarray:
    """The matrix that takes a CRC past 2**power zero bytes."""
    if power:
        half = _doubled(power - 1)
        return _times(half, half)
    column = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        column = (column >> np.uint32(1)) ^ np.where(column & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return column


@functools.lru_cache(maxsize=4096)
def _past(length: int) -> np.ndarray:
    """The same for any number of bytes, as a table for each byte of the CRC."""
    table = (np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for power in range(length.bit_length()):
        if length >> power & 1:
            table = _times(_doubled(power), table)
    return table.reshape(4, 256)


def joined_crc(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each two strings one after another, from theirs and the second's length."""
    sizes, which = np.unique(lengths, return_inverse=True)
    tables = np.stack([_past(int(n)) for n in sizes]) if len(sizes) else np.zeros((1, 4, 256), np.uint32)
    out = second.copy()
    for byte in range(4):
        out ^= tables[which, byte, first >> np.uint32(8 * byte) & np.uint32(255)]
    return out


@dataclass(frozen=True)
class Features:
    """Buckets of the runs of one to three words of some rows of text, those of a run of
    two or three at its last word; ``row`` is the row of each word."""

    row: np.ndarray
    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    # False for words that were counted before and stand here for the runs they begin.
    fresh: np.ndarray


def features(texts: pa.Array, carried: np.ndarray, buckets: int = BUCKETS) -> Features:
    """Words become indices of a dictionary; neighbouring indices are pairs, pairs and the
    word after them runs of three. Each distinct run gets its CRC once, from those of
    its parts. The first ``carried`` words of a row are not fresh."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    words, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(pc.filter(words, real))
    row = pc.filter(row, real).to_numpy().astype(np.int64)
    index, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary())
    size = max(len(known), 1)
    lengths = pc.binary_length(known).to_numpy().astype(np.int64)
    crc = np.fromiter(map(zlib.crc32, known.to_pylist()), np.uint32, len(known))
    space = np.full(1, zlib.crc32(b" "), np.uint32)

    def spaced(values: np.ndarray) -> np.ndarray:
        return joined_crc(values, np.broadcast_to(space, values.shape), np.ones(len(values), np.int64))

    def extended(before: np.ndarray, crcs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the distinct runs of ``before`` and a word, and their CRCs."""
        runs = pc.dictionary_encode(pa.array(before * size + word))
        codes = runs.dictionary.to_numpy()
        left, right = codes // size, codes % size
        return runs.indices.to_numpy().astype(np.int64), joined_crc(spaced(crcs)[left], crc[right], lengths[right])

    bucket = (crc % np.uint32(buckets)).astype(np.int64)
    first_of_row = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(texts)))))[:-1] if len(texts) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - first_of_row[row] if len(row) else row
    second, third = np.flatnonzero(place >= 1), np.flatnonzero(place >= 2)
    two = three = np.full(len(row), -1, np.int64)
    if len(second):
        pairs, crcs = extended(index[second - 1], crc, index[second])
        two = two.copy()
        two[second] = (crcs % np.uint32(buckets))[pairs]
        if len(third):
            at = np.full(len(row), -1, np.int64)
            at[second] = pairs
            triples, crcs = extended(at[third - 1], crcs, index[third])
            three = three.copy()
            three[third] = (crcs % np.uint32(buckets))[triples]
    return Features(row, bucket[index], two, three, place >= carried[row] if len(row) else np.zeros(0, bool))


def _segments(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text cut between words, each part after the first behind the two words before it."""
    raw = np.frombuffer(text, np.uint8)
    at, carry = 0, b""
    while at < len(raw):
        end = at + SLICE
        while end < len(raw):
            gap = np.flatnonzero(_IS_SEPARATOR[raw[end : end + SLICE]])
            if len(gap):
                end += int(gap[0])
                break
            end += SLICE
        part = text[at : min(end, len(raw))]
        before = carry.split()
        yield b" ".join((*before, part)), len(before)
        # The last two words of what there was; separators are ASCII, so bytes will do.
        tail = np.flatnonzero(~_IS_SEPARATOR[np.frombuffer(part, np.uint8)])
        if len(tail):
            own = _last_words(part[: int(tail[-1]) + 1])
            carry = b" ".join([*before, *own][-2:])
        at = end


def _last_words(part: bytes) -> list[bytes]:
    """Up to two words at the end of a text that ends with one."""
    separate = _IS_SEPARATOR[np.frombuffer(part, np.uint8)]
    found, end = [], len(part)
    while end > 0 and len(found) < 2:
        gap = np.flatnonzero(separate[:end])
        start = int(gap[-1]) + 1 if len(gap) else 0
        found.append(part[start:end])
        solid = np.flatnonzero(~separate[:start])
        end = int(solid[-1]) + 1 if len(solid) else 0
    return found[::-1]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(first, rows, texts, carried) of the rows of a batch by slices; the parts of a text
    longer than a slice come one by one, for the same row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE:
            yield first, i - first, texts.slice(first, i - first), np.zeros(i - first, np.int64)
            first, held = i, 0
        held += size
        if size > SLICE:
            for part, carried in _segments(texts[i].as_buffer().to_pybytes()):
                yield i, 1, pa.array([part], pa.binary()).cast(pa.large_string()), np.array([carried], np.int64)
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts) - first, texts.slice(first), np.zeros(len(texts) - first, np.int64)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all rows by bucket. A task sends one row for each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, some, carried in _slices(batch.column(0)):
                found = features(some, carried, buckets)
                total += np.bincount(found.one[found.fresh], minlength=buckets)
                total += np.bincount(found.two[found.fresh & (found.two >= 0)], minlength=buckets)
                total += np.bincount(found.three[found.three >= 0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return texts.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: floor(1000 ln of how much likelier the target has it), both
    sides smoothed by one. ``buckets`` numbers come to the driver, whatever the corpus."""
    spark = docs.sparkSession
    each = bucket_counts(docs, buckets=buckets).withColumnRenamed("n", "s")
    wanted = bucket_counts(target, buckets=buckets).withColumnRenamed("n", "t")
    both = spark.range(buckets).select(F.col("id").alias("bucket")).join(each, "bucket", "left").join(wanted, "bucket", "left")
    stored = materialize(both.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "bucket_counts")
    total = stored.agg(F.sum("s").cast("double").alias("S"), F.sum("t").cast("double").alias("T"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * (total.select("S").scalar() + buckets) / ((s + 1) * (total.select("T").scalar() + buckets))
    gains = stored.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).toArrow().sort_by("bucket")
    return gains.column("gain").to_numpy()


def weight(text: Column, gains: np.ndarray) -> Column:
    """A struct (n_words, n_features, weight): weight is the sum of the gains of the features
    of a text, each as often as it occurs; zero for a null or wordless text."""

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weighed(texts: pa.Array) -> pa.Array:
        words, count, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        at_none = np.append(gains, 0)  # place -1 is a run that there is not
        for first, rows, some, carried in _slices(texts):
            found = features(some, carried, len(gains))
            once = np.where(found.fresh, at_none[found.one] + at_none[found.two], 0) + at_none[found.three]
            n = found.fresh * (1 + (found.two >= 0)) + (found.three >= 0)
            for out, values in ((words, found.fresh), (count, n), (total, once)):
                sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
                edges = np.searchsorted(found.row, np.arange(rows + 1))
                out[first : first + rows] += np.diff(sums[edges])
        return pa.StructArray.from_arrays([pa.array(words), pa.array(count), pa.array(total)], ["n_words", "n_features", "weight"])

    return weighed(text)


def noise(key: Column, seed: int = SEED) -> Column:
    """floor of 1000 times a Gumbel variable that follows from the key, a null being the
    empty string: the highest sums of log-weight and noise are a draw without replacement."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def scored(
    docs: DataFrame, target: DataFrame, seed: int = SEED, buckets: int = BUCKETS, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """A stored table (row, doc, n_words, n_features, weight, score): each row of ``docs``
    (doc_id, text and any others) under a number of its own, with the columns to ``keep``,
    doc_id among them, as a struct."""
    gains = bucket_gains(docs, target, buckets)
    each = docs.select(F.struct(*keep).alias("doc"), weight(docs["text"], gains).alias("w"))
    return materialize(
        each.select(
            F.monotonically_increasing_id().alias("row"), "doc", "w.*", (F.col("w.weight") + noise(F.col("doc.doc_id"), seed)).alias("score")
        ),
        "importance",
    )


def ranked(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, doc_id, n_features, weight, score, rank) of all scored rows.

    Of the N rows with ``min_words`` words or more, floor(percent * N / 100) are drawn: those
    of the highest scores, of equal ones the smallest doc_id, one without doc_id last. The
    others have no rank. Rows alike in both are taken by their features and their number.
    The order comes from a sort over all tasks.
    """
    long_enough = F.col("n_words") >= min_words
    slim = rows.select("row", F.col("doc.doc_id").alias("doc_id"), "n_features", "weight", "score", long_enough.alias("eligible"))
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    placed = numbered(slim, order, "place")
    drawn = placed.agg(F.floor(F.count_if("eligible") * percent / 100).alias("n")).scalar()
    rank = F.when(F.col("eligible") & (F.col("place") < drawn), F.col("place") + 1).cast("long")
    return placed.select("row", "doc_id", "n_features", "weight", "score", rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns. An empty target weighs
    by rarity alone; empty ``docs`` give no rows. Every row counts, repeated ones too."""
    rows = scored(docs, target, seed, buckets, docs.columns)
    drawn = materialize(ranked(rows, percent, min_words).filter("rank is not null").select("row", "score"), "drawn")
    lowest = drawn.agg(F.min("score").alias("score")).scalar()
    return rows.filter(F.col("score") >= lowest).join(drawn.select("row"), "row", "left_semi").select("doc.*")
