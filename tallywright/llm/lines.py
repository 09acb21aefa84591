"""Lines that many documents repeat: found by hash, reported as bitmaps per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.text import let, lines, lower_ascii, trim
from tallywright.sources.scratch import materialize

MIN_DOCS = 5
MIN_CHARS = 40
# Rows of one key that one task streams; a key with more is dealt into chunks.
CHUNK = 500
WORD_BITS = 64


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells apart rows that share a doc_id; equal rows have equal keys."""
    return F.xxhash64(doc_id, text)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, h1, h2, pos) for each line whose key has ``min_chars`` code points
    or more. The key is the line without ASCII white space at its ends and with A-Z
    in lower case, given as a hash of 128 bits."""
    each = docs.select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), F.posexplode(lines(lower_ascii(F.col("text")))).alias("pos", "line")
    ).select("doc_id", "row", "pos", trim(F.col("line")).alias("key"))
    return each.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "row", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"), "pos"
    )


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, pos) of each line to drop: its key is in ``min_docs`` documents or
    more, and this is not the largest doc_id of them.

    Only keys that occur often enough leave the first step, which combines counts in
    each task. Their lines are range-partitioned by hash, sorted within by document
    from the largest and by position, and streamed: the first of a key is the one
    that stays, and each change of document counts. A key with more than ``CHUNK``
    lines is dealt into chunks by document; each chunk streams alone and gives one
    row, its first document and its number of documents.

    Rows that share a doc_id count as one document; so do all rows without one,
    which come after every other.
    """
    found = materialize(line_hashes(docs, min_chars), "line_hashes")
    often = materialize(
        found.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs), "frequent_lines"
    )
    chunk = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / CHUNK))
    some = materialize(found.join(often, ["h1", "h2"]).withColumn("chunk", chunk).drop("n"), "repeated_lines")
    keys = ["h1", "h2", "chunk"]
    tasks = int(some.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = some.select(*keys, "doc_id", "pos").repartitionByRange(tasks, *keys)
    stream = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("doc_id"), "pos")
    before = F.lag("doc_id").over(stream)
    firsts = (
        ranged.withColumn("place", F.row_number().over(stream))
        .withColumn("opens", (F.col("place") == 1) | ~F.col("doc_id").eqNullSafe(before))
        .groupBy(*keys)
        .agg(F.max(F.when(F.col("place") == 1, F.col("doc_id"))).alias("first"), F.count_if("opens").alias("docs"))
    )
    shared = (
        firsts.groupBy("h1", "h2")
        .agg(F.max("first").alias("holder"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "holder")
    )
    return (
        some.join(materialize(shared, "shared_lines"), ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
        .select("doc_id", "row", "pos")
    )


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc_id, row, drops) from (doc_id, row, pos): a sparse bitmap for each document
    with a line to drop, as its words of 64 lines that are not zero. Lines whose bit
    is not set are kept; a document that is not listed keeps all."""
    bit = F.expr(f"shiftleft(1L, cast(pos % {WORD_BITS} as int))")
    return (
        dropped.groupBy("doc_id", "row", F.floor(F.col("pos") / WORD_BITS).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("doc_id", "row")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))
    )


def line_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, drops): compressed bitmaps of the lines which documents lose."""
    return drop_bitmaps(repeated_lines(docs, min_docs, min_chars))


def dropped_positions(drops: Column) -> Column:
    """The positions that are set in a sparse bitmap, ascending; none of a null."""
    inside = F.transform(
        drops,
        lambda w: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda b: F.getbit(w["bits"], b) == 1),
            lambda b: w["word"] * WORD_BITS + b,
        ),
    )
    return F.coalesce(F.flatten(inside), F.array().cast("array<int>"))


def kept_text(text: Column, drops: Column) -> Column:
    """The text without the lines that are set in the bitmap; as it is without a bitmap."""
    all_lines = lines(text)
    positions = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), dropped_positions(drops))
    joined = let(all_lines, lambda a: F.array_join(F.transform(positions, lambda i: F.get(a, i)), "\n"))
    return F.when(drops.isNull(), text).otherwise(joined)


def with_drops(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc, drops): each row of docs as a struct, beside its bitmap or null."""
    row = docs.select(F.struct("*").alias("doc"), row_key(docs["doc_id"], docs["text"]).alias("key"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("row"))
    return row.join(bitmaps.hint("shuffle_hash"), same, "left").select("doc", "drops")


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the repeated lines, and with n_chars of what is left where docs
    have that column. All rows and columns stay; a document that loses all lines has
    an empty text, one that loses none is returned as it is."""
    found = with_drops(docs, line_bitmaps(docs.select("doc_id", "text"), min_docs, min_chars))
    text = kept_text(F.col("doc.text"), F.col("drops"))
    inner = {c: F.col("doc")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        new = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        inner["n_chars"] = F.when(F.col("drops").isNull(), F.col("doc.n_chars")).otherwise(new)
    return found.select(*[c.alias(n) for n, c in inner.items()])
