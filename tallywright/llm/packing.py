"""Documents packed into training sequences of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.tokens import encoder
from tallywright.sources.scratch import materialize

CAPACITY = 1024
END = 2
# Pieces that one task packs together; sequences of different groups are never mixed.
GROUP = 16384

PIECE = "piece int, start long, length long, ids_crc32 long, spread long"


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first one takes what the full ones leave."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of the token ids of each row of ``docs`` (doc_id, text), a null text being
    empty. A document is its ids and then the id 2; only one longer than ``capacity``
    is cut. ``spread`` numbers the pieces over all tasks; ``ids`` are added on demand.
    Every row counts, rows that repeat a doc_id or have none too; a doc_id may be of any type.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column(1)):
                ids = np.append(encode.ids(text.as_py()), np.uint32(END)).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    own = (part.view("<i4"),) if with_ids else ()
                    rows.append((at, piece, start, length, zlib.crc32(part.tobytes()), number, *own))
                    number += 1
            columns = list(zip(*rows)) or [[] for _ in kinds]
            own_ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([own_ids, *(pa.array(c, k) for c, k in zip(columns[1:], kinds[1:]))], names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECE}"
    names = ["doc_id", *(c.split()[0] for c in PIECE.split(", "))]
    if with_ids:
        kinds, schema, names = [*kinds, pa.list_(pa.int32())], f"{schema}, ids array<int>", [*names, "ids"]
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, by sums of squares.

    Pieces are taken from the longest. Each goes into an open bin with room for it,
    of the residual gap for which the sum over gaps of the squared number of open
    bins becomes smallest; of equal ones the smallest gap. A bin is opened where
    none has room.
    """
    never = -(1 << 40)
    gain = np.full(capacity + 1, never, np.int64)  # what the sum loses when a bin leaves a gap
    cost = np.ones(capacity + 1, np.int64)  # what it grows by when a bin comes to a gap
    cost[0] = 0  # full bins are closed
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        change = cost[: capacity - size] - gain[size:capacity]
        best = int(change.argmin()) if size < capacity else 0
        if size < capacity and gain[size + best] != never:
            gap = size + best
            chosen = open_bins[gap].pop()
            count = len(open_bins[gap])
            cost[gap], gain[gap] = 2 * count + 1, 2 * count - 1 if count else never
        else:
            gap, chosen = capacity, opened
            opened += 1
        bins[i], offsets[i] = chosen, capacity - gap
        rest = gap - size
        if rest:
            open_bins[rest].append(chosen)
            count = len(open_bins[rest])
            cost[rest], gain[rest] = 2 * count + 1, 2 * count - 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A stored table of pieces (length, spread, any others) with ``sequence_id`` and
    ``offset`` of each; a sequence has no gap but at its end.

    Full pieces are sequences of their own. The others are dealt by ``spread``, whatever
    their document, into groups of about ``GROUP``; each group is packed in a task
    of its own. Their number follows the rows, and a group wastes a few sequences.
    """
    short = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // GROUP))
    columns = pieces.columns

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("spread", "ascending")])
        bins, offsets = place(table.column("length").to_numpy(), capacity)
        number = table.column("group").to_numpy() << 32 | bins
        return table.select(columns).append_column("sequence_id", pa.array(2 * number)).append_column("offset", pa.array(offsets))

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    dealt = short.withColumn("group", F.pmod(F.xxhash64("spread"), F.lit(groups)))
    whole = pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("long")}
    )
    return dealt.groupBy("group").applyInArrow(packed, schema).unionByName(whole)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places. An empty table has no pieces."""
    pieces = materialize(token_pieces(docs, capacity, tokenizer, with_ids), "pieces")
    return pack(pieces, capacity).drop("spread")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pieces packed with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
