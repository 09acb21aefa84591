"""SimHash fingerprints of word shingles, and groups of documents near in Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.graph import components
from tallywright.sources.scratch import materialize

SEED = 42
BITS = 64
# Shingles hashed at a time, so that a long text needs no more memory than a short one.
CHUNK = 1 << 16
# Fingerprints of one bucket compared in one piece; larger buckets are cut into tiles.
TILE = 2048
# Words of 64 candidates compared at a time in one task.
LANES = 1 << 16


def _bit_sums(digests: bytes) -> np.ndarray:
    """How many of the 8-byte digests have each bit, the highest bit first."""
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).view(np.uint64).reshape(-1, 8)
    # Eight one-byte counters per machine word; a byte holds sums of up to 255 rows.
    parts = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
    return parts.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)


def fingerprint_of(text: bytes | None, shingle: int = 4) -> int:
    """The fingerprint of one UTF-8 text, as a signed 64-bit number."""
    words = (text or b"").lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - shingle + 1, 1)
    starts, ends = starts[:n], ends[min(shingle, len(words)) - 1 :]
    sums = np.zeros(BITS, np.int64)
    for i in range(0, n, CHUNK):
        spans = map(slice, starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist())
        sums += _bit_sums(b"".join(map(xxhash.xxh64_digest, map(joined.__getitem__, spans), repeat(SEED))))
    return int.from_bytes(np.packbits(2 * sums > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """SimHash of the shingles of a text column: a bit is one where over half of the
    XXH64 hashes (seed 42) of all shingles, repeats included, have it.

    A-Z are lower-cased; words are runs without ASCII white space. A text of fewer
    words than a shingle is one shingle, a null or wordless text has fingerprint 0.
    """

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return hashed(text)


def masks(radius: int) -> list[int]:
    """Signed bit masks such that two fingerprints within the radius agree under one
    at least: of radius + 2 blocks of bits, two stay untouched."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    found = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def _planes(prints: np.ndarray) -> np.ndarray:
    """Row i has bit i of all fingerprints, 64 fingerprints to a word."""
    padded = np.zeros(-len(prints) % 64 + len(prints), np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _near(planes: np.ndarray, prints: np.ndarray, row: np.ndarray, word: np.ndarray, valid: np.ndarray, radius: int):
    """Pairs within the radius, of row[i] with the valid ones among 64 candidates in word[i].

    All 64 distances of a lane are counted at once, each bit place of the counters
    being a word of its own. The counters start so that they overflow just beyond
    the radius. Two planes at a time enter by a full adder. A lane is abandoned
    once all of its distances have overflowed.
    """
    places = max(radius.bit_length(), 1)
    start = (1 << places) - 1 - radius
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(row), ones if start >> i & 1 else 0, np.uint64) for i in range(places)]
    query = prints[row]
    for first in range(0, BITS, 8):
        for p in range(first, first + 8, 2):
            x = planes[p][word] ^ (-(query >> np.uint64(p) & np.uint64(1)))
            y = planes[p + 1][word] ^ (-(query >> np.uint64(p + 1) & np.uint64(1)))
            half = counters[0] ^ x
            carry = (counters[0] & x) | (half & y)
            counters[0] = half ^ y
            for i in range(1, places):
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
            valid = valid & ~carry
        live = np.flatnonzero(valid)
        if len(live) < len(valid):
            row, word, valid, query = row[live], word[live], valid[live], query[live]
            counters = [c[live] for c in counters]
    hits = np.unpackbits(valid.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lane, place = np.nonzero(hits)
    return row[lane], word[lane] * 64 + place


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining the trees of each a[i] and b[i]; roots are smallest rows."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up


def linked(bucket: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links which join the same fingerprints as all pairs within the radius in a
    bucket do, one for each fingerprint at most. The rows are sorted by bucket."""
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    ends = np.concatenate((cuts, [len(bucket)]))
    end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
    rows = np.flatnonzero(end > np.arange(len(bucket)) + 1)
    root = np.arange(len(bucket))
    if len(rows):
        planes = _planes(prints)
        first, last = (rows + 1) >> 6, (end[rows] - 1) >> 6
        count = last - first + 1
        upto = np.cumsum(count)
        ones = np.uint64(0xFFFFFFFFFFFFFFFF)
        begin = 0
        while begin < len(rows):
            done = upto[begin - 1] if begin else 0
            stop = max(int(np.searchsorted(upto, done + LANES)), begin + 1)
            part = slice(begin, stop)
            row = np.repeat(rows[part], count[part])
            word = np.arange(len(row)) - np.repeat(upto[part] - done - count[part], count[part]) + np.repeat(first[part], count[part])
            low = np.maximum(row + 1 - word * 64, 0).astype(np.uint64)
            high = np.minimum(end[row] - word * 64, 64).astype(np.uint64)
            valid = (ones << low) & (ones >> (np.uint64(64) - high))
            root = _merge(root, *_near(planes, prints, row, word, valid, radius))
            begin = stop
    moved = np.flatnonzero(root != np.arange(len(root)))
    return prints[moved], prints[root[moved]]


def _links(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(bucket: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            a, b = linked(bucket, prints, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        bucket, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            bucket = np.concatenate((bucket, batch.column(0).to_numpy()))
            prints = np.concatenate((prints, batch.column(1).to_numpy().view(np.uint64)))
            if len(bucket) >= CHUNK:
                cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                yield out(bucket[:cut], prints[:cut])
                bucket, prints = bucket[cut:], prints[cut:]
        yield out(bucket, prints)

    return compare


def near_pairs(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) between the distinct values of ``fingerprint`` whose components are
    those of all pairs that differ in up to ``radius`` bits.

    Each fingerprint goes into one bucket for every two of radius + 2 blocks of its
    bits; two fingerprints within the radius share a bucket. Buckets are compared
    by bit planes. A bucket beyond ``TILE`` is dealt into chunks, and each pair of
    chunks is a tile of its own for another task, so none holds a whole hot bucket.
    """
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(m))) for i, m in enumerate(masks(radius))])
    placed = prints.select("fingerprint", F.explode(keys).alias("bucket"))
    large = materialize(placed.groupBy("bucket").count().filter(F.col("count") > TILE), "large_buckets")
    chunks = F.coalesce(F.ceil(F.col("count") / TILE), F.lit(1))
    chunk = F.pmod(F.xxhash64("fingerprint"), F.col("chunks"))
    tile = F.xxhash64("bucket", F.least("chunk", "other"), F.greatest("chunk", "other"))
    tiles = (
        placed.join(large, "bucket", "left")
        .withColumn("chunks", chunks)
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select(F.when(F.col("chunks") == 1, F.col("bucket")).otherwise(tile).alias("bucket"), "fingerprint")
    )
    return tiles.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_links(radius), "a long, b long")


def classes(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(fingerprint, root, component_id) of every distinct fingerprint in a stored table
    (doc_id, fingerprint). The root is one fingerprint for each component, the
    component_id the smallest doc_id that links reach, null only where no document
    of the component has an id."""
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = materialize(components(near_pairs(distinct.select("fingerprint"), radius)), "roots")
    members = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first"
    )
    members = materialize(members, "members")
    lowest = materialize(members.groupBy("root").agg(F.min("first").alias("component_id")), "lowest_ids")
    return members.join(lowest, "root").select("fingerprint", "root", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Fingerprints are linked where they differ in up to ``radius`` bits; a
    component_id is the smallest doc_id of all documents which links join.
    Equal fingerprints, those of empty, null and wordless texts included, are
    linked. Rows with a null doc_id take part; repeated rows are returned each.
    """
    prints = materialize(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fingerprint")), "prints")
    return prints.join(classes(prints, radius), "fingerprint").select("doc_id", "fingerprint", "component_id")


def hexadecimal(value: Column) -> Column:
    """16 lower-case hexadecimal digits of a long."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near copies: that with
    the smallest doc_id. All columns of docs are returned, whatever their names.

    Of rows that repeat the doc_id and fingerprint of the one kept, the smallest by
    all columns is returned. A document without a doc_id stays only where its whole
    group has none. An empty table gives an empty table.
    """
    stored = materialize(
        docs.select(F.struct("*").alias("row"), fingerprint(docs["text"], shingle).alias("fingerprint")), "printed"
    )
    prints = stored.select(F.col("row.doc_id").alias("doc_id"), "fingerprint")
    counted = prints.groupBy("doc_id", "fingerprint").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "fingerprint", "n")).alias("first")
    kept = materialize(
        counted.join(classes(prints, radius), "fingerprint").groupBy("root").agg(first).select(
            F.col("first.doc_id").alias("doc_id"), F.col("first.fingerprint").alias("print"), F.col("first.n").alias("n")
        ),
        "kept",
    )
    same = (F.col("fingerprint") == F.col("print")) & F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
    found = stored.join(kept, same)
    repeated = found.filter("n > 1").groupBy("doc_id", "print").agg(F.min("row").alias("row"))
    return found.filter("n = 1").select("row.*").unionByName(repeated.select("row.*"))
