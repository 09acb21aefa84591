"""Token counts of documents in flat token files, found by their separators alone."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.llm.tokens import END_OF_TEXT, encoder
from tallywright.sources.scratch import materialize, scratch_path

# Ids of one block, which is searched at a time; the last one of a file may be shorter.
BLOCK = 1 << 16
# Bytes of a file that one task reads.
SPAN = 1 << 25
# Blocks of a file whose prefix one task forms.
CHUNK = 1024


# Characters of the lines of the order; a separator must hold a byte that is none of them.
ORDER = b"0123456789abcdef =-"


def id_width(size: int, end: int) -> int:
    """Bytes of an id in a file, the lowest first: two where the vocabulary allows, else four.

    The separator must have a byte that no line of the order has; four bytes give that."""
    if size <= 1 << 16 and end.to_bytes(2, "little").strip(ORDER):
        return 2
    if size <= 1 << 24:
        return 4
    raise ValueError("the vocabulary has too many ids")


def id_bytes(ids: np.ndarray, width: int) -> bytes:
    """Ids as little-endian numbers; ValueError if one does not fit."""
    if len(ids) and int(ids.max()) >> (8 * width):
        raise ValueError(f"the id {int(ids.max())} needs more than {width} bytes")
    return ids.astype(f"<u{width}").tobytes()


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Flat token files below ``path``, one for each input partition, and the order in them.

    A file (``kind=tokens/file=N``) is the ids of its documents, each followed by the
    end-of-text id, and nothing else. The order (``kind=order/file=N``) tells the doc_id at
    each place; both are written by the same task, so they agree whichever attempt of
    it succeeds. The text of a special token is encoded as ordinary text, so only separators
    have that id. Null and empty texts are a separator alone; every row of ``docs``
    (doc_id, text) is a document of its own, and a doc_id may be of any type or null.
    """
    end, width = separator_of(tokenizer)
    mark = end.to_bytes(width, "little")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        file, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    # The writer puts the separator behind each row.
                    rows.append((id_bytes(encode.ids(text, special=False), width), "tokens", file, place))
                    rows.append((f"{place} {'' if doc_id is None else '=' + doc_id.encode().hex()}".encode(), "order", file, place))
                    place += 1
                columns = list(zip(*rows))
                kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["value", "kind", "file", "place"])

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(encoded, "value binary, kind string, file long, place long")
    ordered = rows.sortWithinPartitions("kind", "file", "place").select(F.col("value").cast("string").alias("value"), "kind", "file")
    # An encoding of one byte for each character lets the separator be any bytes; rows are written as they are.
    separated = ordered.write.option("encoding", "ISO-8859-1").option("lineSep", mark.decode("latin-1"))
    separated.partitionBy("kind", "file").mode("overwrite").text(path)


def separator_of(tokenizer: str | None = None) -> tuple[int, int]:
    """The end-of-text id and the width of ids in a file."""
    slow = encoder(tokenizer).slow
    end = slow.token_to_id(END_OF_TEXT)
    return end, id_width(slow.get_vocab_size(), end)


def read_order(spark: SparkSession, path: str, tokenizer: str | None = None) -> DataFrame:
    """(file, place, doc_id) of written token files, the doc_id as a string."""
    end, width = separator_of(tokenizer)
    mark = end.to_bytes(width, "little").decode("latin-1")
    separated = spark.read.schema("value string, file long").option("encoding", "ISO-8859-1").option("lineSep", mark)
    place = F.substring_index("value", " ", 1).cast("long")
    name = F.unhex(F.substring_index("value", "=", -1)).cast("string")
    lines = separated.text(f"{path}/kind=order")
    return lines.select("file", place.alias("place"), F.when(F.col("value").contains("="), name).alias("doc_id"))


def file_spans(spark: SparkSession, path: str, width: int, span: int = SPAN) -> DataFrame:
    """(file, offset, size): the files below ``path`` in pieces of ``span`` bytes, each for a
    task of its own, whatever the length of a file. Only names and lengths are read here."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), "length")
    odd = F.when(F.col("length") % width != 0, F.raise_error(F.concat("file", F.lit(" ends within an id"))).cast("long")).otherwise(F.col("length"))
    stored = materialize(files.select("file", odd.alias("length")).filter("length > 0"), "token_file_names")
    tasks = stored.agg(F.sum(F.ceil(F.col("length") / span))).first()[0] or 1
    offset = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(span).cast("long")))
    pieces = stored.select("file", "length", offset.alias("offset"))
    sized = pieces.select("file", "offset", F.least(F.lit(span), F.col("length") - F.col("offset")).alias("size"))
    return sized.repartition(int(tasks), "file", "offset")


def separators(spans: DataFrame, end: int, width: int, block: int = BLOCK) -> DataFrame:
    """(file, block, tokens, ends): the number of ids of each block and where separators are.

    Each task opens its files at its own offsets, by the file system that the address
    names (of a mount that all executors have, or any that pyarrow knows). A span is a
    multiple of a block, or else the blocks would not be those of the file.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, offset, size in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = fs.FileSystem.from_uri(name)
                with store.open_input_file(place) as file:
                    for at in range(offset, offset + size, block * width):
                        data = file.read_at(min(block * width, offset + size - at), at)
                        ids = np.frombuffer(data, f"<u{width}")
                        ends = np.flatnonzero(ids == end).astype(np.int32)
                        columns = [pa.array([name]), pa.array([at // (block * width)]), pa.array([len(ids)], pa.int32()), pa.array([ends], pa.list_(pa.int32()))]
                        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "tokens", "ends"])

    return spans.mapInArrow(scan, "file string, block long, tokens int, ends array<int>")


def token_counts(
    spark: SparkSession, path: str, end: int, width: int = 2, block: int = BLOCK, span: int = SPAN
) -> DataFrame:
    """(file, place, n_tokens, ended): the ids of each document of each flat file below
    ``path``, in its order; file is the address of the file.

    Every block is searched alone for separators. A prefix scan then gives each block
    the number of documents before it and the place of the last separator before it:
    first over chunks of ``CHUNK`` blocks, then over the chunks of a file, so no file
    however long meets in one task whole. Ids after the last separator of a file are
    a document that has not ended. Two separators in a row are an empty document.
    """
    whole_blocks = max(1, span // (block * width)) * block * width
    found = materialize(separators(file_spans(spark, path, width, whole_blocks), end, width, block), "separators").withColumns(
        {
            "chunk": F.floor(F.col("block") / CHUNK),
            "last": F.col("block") * block + F.element_at("ends", F.when(F.size("ends") > 0, F.lit(-1))),
        }
    )
    chunks = found.groupBy("file", "chunk").agg(
        F.sum(F.size("ends")).alias("n"), F.max("last").alias("at"), F.sum("tokens").alias("tokens")
    )
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(
        "file", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs"), F.max("at").over(before).alias("at")
    )
    inside = Window.partitionBy("file", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        found.withColumns({"own_docs": F.sum(F.size("ends")).over(inside), "own_at": F.max("last").over(inside)})
        .join(carried, ["file", "chunk"])
        .select(
            "file",
            (F.col("block") * block).alias("start"),
            "ends",
            (F.col("docs") + F.coalesce("own_docs", F.lit(0))).alias("docs"),
            F.coalesce("own_at", "at", F.lit(-1)).alias("at"),
        )
    )
    ended = stitched.select("*", F.posexplode("ends").alias("i", "place_of_end")).select(
        "file",
        (F.col("docs") + F.col("i")).alias("place"),
        (F.col("start") + F.col("place_of_end") - 1 - F.when(F.col("i") == 0, F.col("at")).otherwise(F.col("start") + F.get("ends", F.col("i") - 1))).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    whole = chunks.groupBy("file").agg(F.sum("n").alias("n"), F.coalesce(F.max("at"), F.lit(-1)).alias("at"), F.sum("tokens").alias("tokens"))
    rest = whole.select("file", F.col("n").alias("place"), (F.col("tokens") - F.col("at") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(rest.filter("n_tokens > 0"))


def document_token_counts(
    docs: DataFrame, tokenizer: str | None = None, block: int = BLOCK, span: int = SPAN
) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs`` (doc_id, text), counted in token files that
    are written to the shared folder."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "token_files")
    write_token_files(docs, path, tokenizer)
    kind = docs.schema["doc_id"].dataType.simpleString()
    if docs.isEmpty():
        return spark.createDataFrame([], f"doc_id {kind}, n_tokens long")
    end, width = separator_of(tokenizer)
    counted = token_counts(spark, f"{path}/kind=tokens", end, width, block, span)
    file = F.regexp_extract("file", r"/file=(\d+)/[^/]*$", 1).cast("long")
    order = read_order(spark, path, tokenizer)
    joined = order.join(counted.withColumn("file", file), ["file", "place"])
    return joined.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_tokens")
