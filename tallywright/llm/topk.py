"""Exact top-k inner products by sorted lists without random access."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize

# Vectors of one block of candidates.
BLOCK = 4096
# Queries that are searched for together.
QUERIES = 256
# Bytes of query vectors that are broadcast at a time.
BROADCAST_BYTES = 1 << 25
# Part of each list read before the bounds are looked at again.
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 1.0)
# Bounds of the scores that are exact in doubles, and in longs with room for a bound.
IN_DOUBLES, IN_LONGS = 2.0**53, 2.0**62
# How the whole components of a block are stored: as integers of so many bytes, as doubles, or,
# where the factor takes them beyond these, as doubles that it has yet to multiply.
AS_DOUBLES, BEFORE_FACTOR = 9, 10
SCORE = pa.decimal128(38, 0)
MOST = 10**38 - 1


def _whole(values: np.ndarray, factor: int | None) -> tuple[int, np.ndarray]:
    """(kind, values) of one vector, floor(factor * x) of each component being an integer."""
    if values.dtype.kind != "f":
        values = values.astype(np.int64)
    else:
        values = values.astype(np.float64)
        with np.errstate(over="ignore"):
            scaled = values if factor is None else np.floor(values * factor)
        if not np.isfinite(scaled).all():
            return BEFORE_FACTOR, values
        if len(scaled) and max(scaled.max(), -scaled.min()) >= 2.0**63:
            return AS_DOUBLES, scaled
        values = scaled.astype(np.int64)
    for width in (2, 4):
        kind = np.iinfo(f"<i{width}")
        if not len(values) or kind.min <= values.min() and values.max() <= kind.max:
            return width, values
    return 8, values


def _stored(kind: int) -> str:
    return f"<i{kind}" if kind <= 8 else "<f8"


def _blocks(rows: int, factor: int | None):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Up to ``rows`` vectors of one length and kind to a row: their ids and all components."""
        waiting: dict[tuple[int, int], tuple[list, list]] = {}

        def out(key: tuple[int, int]) -> pa.RecordBatch:
            ids, vectors = waiting.pop(key)
            data = np.concatenate(vectors).astype(_stored(key[1])).tobytes()
            columns = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["size", "kind", "ids", "data"])

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                kind, values = _whole(vector.values.to_numpy(), factor)
                key = len(values), kind
                ids, vectors = waiting.setdefault(key, ([], []))
                ids.append(vec_id)
                vectors.append(values)
                if len(ids) == rows:
                    yield out(key)
        for key in list(waiting):
            yield out(key)

    return pack


def blocks(vectors: DataFrame, rows: int, factor: int | None, name: str) -> DataFrame:
    """A stored table (size, kind, ids, data) of (vec_id, components), cut within each task."""
    packed = vectors.mapInArrow(_blocks(rows, factor), "size int, kind int, ids array<long>, data binary")
    return materialize(packed, name)


def matrix(size: int, kind: int, data: bytes, rows: int, factor: int | None) -> np.ndarray:
    """The components of a block as longs, or as Python integers where they are wider."""
    values = np.frombuffer(data, _stored(kind)).reshape(rows, size)
    if kind <= 8:
        return values.astype(np.int64)
    exact = [[int(x) if kind == AS_DOUBLES else math.floor(Fraction(x) * (factor or 1)) for x in row] for row in values.tolist()]
    return np.array(exact, object).reshape(rows, size)


def _reach(vectors: np.ndarray) -> int:
    """The largest absolute component."""
    return int(max(vectors.max(), -vectors.min())) if vectors.size else 0


class Lists:
    """The components of a block of candidates as one list of (value, place) per dimension,
    sorted by value. The places are those in ``ids``. There is no way from a place to its
    components: they are met as the lists are read, from either end."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.reach, self.size = ids, _reach(vectors), vectors.shape[1]
        self.places = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.places, axis=0)
        self._tables: dict[tuple[int, type], tuple[np.ndarray, ...]] = {}

    def tables(self, depth: int, kind: type) -> tuple[np.ndarray, ...]:
        """What is known by place when ``depth`` entries of each list are read: from the high
        end with the largest and with the smallest value that an unread one may have, and
        from the low end with the smallest and with the largest. An unread component lies
        between the frontier, the last value read, and the far end of its list."""
        if (depth, kind) not in self._tables:
            n, dims = len(self.ids), np.arange(self.size)
            high, low = slice(n - depth, n), slice(0, depth)
            made = []
            for part, frontier, far in ((high, n - depth, 0), (low, depth - 1, n - 1)):
                for unread in (frontier, far):
                    table = np.empty((n, self.size), kind)
                    table[:] = self.values[unread]
                    table[self.places[part], dims] = self.values[part]
                    made.append(table)
            self._tables[depth, kind] = tuple(made)
        return self._tables[depth, kind]


def kind_for(lists: Lists, query: np.ndarray) -> type:
    """Numbers in which the bounds of scores, sums of whole numbers, are exact."""
    bound = 2 * lists.reach * _reach(query) * max(lists.size, 1)
    return next((k for k, most in ((np.float32, 2**24), (np.float64, IN_DOUBLES), (np.int64, IN_LONGS)) if bound < most), object)


def _limits(floors: list, kind: type) -> np.ndarray:
    """Scores to reach, those beyond what the kind can hold at its end."""
    if kind is object:
        return np.array(floors, object)
    most = int(IN_LONGS if kind is np.int64 else IN_DOUBLES)
    return np.array([-most if f == -math.inf else max(-most, min(most, f)) for f in floors], np.int64 if kind is np.int64 else np.float64)


def search(lists: Lists, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: list) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(ids, scores, share of the lists read) for each query, the scores of all being of one
    ``kind_for``: the candidates of a block that can be among its k best, k at most.
    ``floors`` are scores that k others are known to reach, or -inf.

    The lists are read side by side, from the high end where a query's component is
    positive, from the low end where it is negative, to growing depths. What is read
    bounds each score from both sides. A candidate whose upper bound is below k lower
    bounds is out, read or not. A query of which all are out ends there; for the others the
    lists are read on to their ends for what is left alone, which gives the final scores.
    Candidates that tie stay in until then.
    """
    n, ids = len(lists.ids), lists.ids
    kind = kind_for(lists, queries)
    q = queries.astype(kind)
    positive, negative = np.maximum(q, 0), np.minimum(q, 0)
    limits = _limits(floors, kind)
    nothing = -math.inf if kind is not np.int64 else -(1 << 63)
    found: list = [(ids[:0], np.zeros(0, np.int64), 0.0)] * len(q)
    live, rows = np.arange(len(q)), np.arange(n)
    for depth in sorted({max(1, math.ceil(n * share)) for share in DEPTHS}):
        high_most, high_least, low_least, low_most = (t if len(rows) == n else t[rows] for t in lists.tables(depth, kind))
        upper = positive[live] @ high_most.T + negative[live] @ low_least.T
        own = ids[rows] == query_ids[live, None]
        if depth < n and len(rows) >= k:
            lower = positive[live] @ high_least.T + negative[live] @ low_most.T
            lower[own] = nothing
            at = len(rows) - k
            reached = np.sort(lower, axis=1)[:, at] if kind is object else np.partition(lower, at, axis=1)[:, at]
            limits[live] = np.maximum(limits[live], reached)
        able = (upper >= limits[live, None]).astype(bool) & ~own
        if depth == n:
            for i, at in enumerate(live):
                found[at] = *_first(ids[rows], upper[i], able[i], k), 1.0
            return found
        some = able.any(axis=1)
        for at in live[~some]:
            found[at] = ids[:0], np.zeros(0, np.int64), depth / n
        live = live[some]
        if not len(live):
            return found
        rows = rows[able.any(axis=0)]
    return found


def _first(ids: np.ndarray, scores: np.ndarray, able: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of the scores that count, ties to the smaller id."""
    hits = np.flatnonzero(able)
    if len(hits) > 4 * k and scores.dtype != object:  # what is below the k-th of them is no use
        at = len(hits) - k
        hits = hits[scores[hits] >= np.partition(scores[hits], at)[at]]
    chosen = scores[hits] if scores.dtype == object else scores[hits].astype(np.int64)
    order = np.lexsort((ids[hits], -chosen))[:k]
    return ids[hits[order]], chosen[order]


def alike(lists: Lists, queries: list[tuple[int, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Queries in groups whose scores are of one kind of number, ``QUERIES`` at most."""
    groups: dict[type, list] = {}
    for query in queries:
        groups.setdefault(kind_for(lists, query[1]), []).append(query)
    for group in groups.values():
        for at in range(0, len(group), QUERIES):
            yield group[at : at + QUERIES]


def _merged(a: tuple[list, list], b: tuple[list, list], k: int) -> tuple[list, list]:
    """The k highest of two lists of (ids, scores), ties to the smaller id."""
    both = sorted(zip((-s for s in (*a[1], *b[1])), (*a[0], *b[0])))[:k]
    return [i for _, i in both], [-s for s, _ in both]


def _sortable(value: int) -> bytes:
    """Bytes in the order of the integers."""
    size = (abs(value).bit_length() + 8) // 8
    head, body = size.to_bytes(4, "big"), value.to_bytes(size, "big", signed=True)
    if value >= 0:
        return b"\x01" + head + body
    return b"\x00" + bytes(255 - x for x in head) + body


NEAR = "query_id long, vec_id long, score decimal(38, 0), beyond binary"


def top_k(vectors: DataFrame, queries: DataFrame, k: int, factor: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest integer inner products
    with all other vectors, ties to the smaller vec_id; fewer where there are fewer.

    Both tables are (vec_id, components). The components are whole numbers, or with a
    ``factor`` numbers x that stand for floor(factor * x). Rows with a null id take no part, nor
    vectors that are null or hold a null or a component that is not finite. Vectors of another
    length than the query's do not meet it; empty ones meet with the score 0. A query never
    meets rows of its own vec_id. A candidate row that is repeated counts each time; of
    queries that share a vec_id the smallest vector asks. A score is decimal(38, 0) and
    exact; one that is among the k best and has more digits is an error.

    Candidates stay where they are: each task reads its blocks and the queries, which are
    broadcast, ``broadcast_bytes`` of them in a round. A task keeps the k best of each
    query over its blocks, and these meet in the shuffle.
    """
    able = "vec_id is not null and components is not null"

    def sound(x):  # a NaN is larger than any number
        far = F.lit(float("inf"))
        return x.isNotNull() & (x.cast("double") < far) & (x.cast("double") > -far)

    there = vectors.filter(able).filter(F.forall("components", sound)).select("vec_id", "components")
    asking = queries.filter(able).filter(F.forall("components", sound)).groupBy("vec_id").agg(F.min("components").alias("components"))
    held = blocks(there, BLOCK, factor, "vector_blocks")
    asked = materialize(asking.withColumn("part", F.xxhash64("vec_id")), "queries")
    size = asked.agg(F.sum(F.size("components") * 8 + 16)).first()[0] or 0
    rounds = max(1, math.ceil(size / broadcast_bytes))
    near = None
    for number in range(rounds):
        some = asked.filter(F.pmod("part", F.lit(rounds)) == number).drop("part").toArrow().sort_by("vec_id")
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for vec_id, vector in zip(some.column("vec_id").to_pylist(), some.column("components").combine_chunks() if len(some) else []):
            kind, values = _whole(vector.values.to_numpy(), factor)
            exact = matrix(len(values), kind, values.astype(_stored(kind)).tobytes(), 1, factor)[0]
            by_size.setdefault(len(values), []).append((vec_id, exact))
        shared = vectors.sparkSession.sparkContext.broadcast(by_size)

        def scores(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[list, list]] = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    wanted = shared.value.get(r["size"], [])
                    if not wanted:
                        continue
                    ids = np.array(r["ids"], np.int64)
                    lists = Lists(ids, matrix(r["size"], r["kind"], r["data"], len(ids), factor))
                    for some in alike(lists, wanted):
                        query_ids = [i for i, _ in some]
                        known = [best.get(i, ([], [])) for i in query_ids]
                        floors = [x[1][-1] if len(x[1]) == k else -math.inf for x in known]
                        asked_for = np.array([v for _, v in some]).reshape(len(some), -1)
                        for query_id, before, (near_ids, found, _) in zip(query_ids, known, search(lists, np.array(query_ids, np.int64), asked_for, k, floors)):
                            best[query_id] = _merged(before, (near_ids.tolist(), found.tolist()), k)
            flat = [(q, i, s) for q, (ids, found) in best.items() for i, s in zip(ids, found)]
            columns = [
                pa.array([q for q, _, _ in flat], pa.int64()),
                pa.array([i for _, i, _ in flat], pa.int64()),
                pa.array([max(-MOST, min(MOST, int(s))) for _, _, s in flat], SCORE),
                pa.array([_sortable(int(s)) if abs(s) > MOST else None for _, _, s in flat], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "beyond"])

        found = held.mapInArrow(scores, NEAR)
        near = found if near is None else near.unionByName(found)
    # A score of more digits stands at the end of the range, and its bytes tell the order there.
    key = F.when(F.col("score") < 0, F.coalesce("beyond", F.lit(b"\x02"))).otherwise(F.coalesce("beyond", F.lit(b"")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc(key), "vec_id")
    first = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    wrong = F.raise_error(F.lit("a score among the best has more than 38 digits")).cast("decimal(38, 0)")
    return first.select("query_id", "rank", "vec_id", F.when(F.col("beyond").isNull(), F.col("score")).otherwise(wrong).alias("score"))
