"""Benchmark passages in documents: exact windows of words, and how to be rid of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.lines import drop_bitmaps, dropped_positions, row_key
from tallywright.llm.text import let, lower_ascii
from tallywright.sources.scratch import materialize

WINDOW = 10
# ASCII but digits and letters; upper-case letters are separators once a text is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS_AS_WRITTEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS_AS_WRITTEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bits of the first test for each window of the benchmark, and how many of them it sets,
# all in one word: one window of the corpus in some thousand passes without being listed.
BITS_EACH, BITS_SET, WORD = 32, 4, 64
# Listed windows of one scan of the documents (32 MB of bits), and bytes of text of
# listed windows in one broadcast. More of either take more rounds, not other ways.
SCAN_WINDOWS = 1 << 23
BROADCAST_BYTES = 1 << 25


def words(text: Column) -> Column:
    """The words of a text in lower case (A-Z only); none of a null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def _window_hash(hashes: Column, at: Column, length: Column, longest: int) -> Column:
    """One hash of the ``length`` words from ``at``; nulls beyond the length leave it as it is."""
    return F.xxhash64(*[F.when(F.lit(k) < length, F.get(hashes, at + k)) for k in range(longest)])


def _places(size: Column, length: Column) -> Column:
    """0, 1, ... of each window of ``length`` words among ``size``; none if there are fewer."""
    return F.when(size >= length, F.sequence(F.lit(0), size - length)).otherwise(F.array().cast("array<int>"))


def _text_of(found: Column, at: Column, length: Column) -> Column:
    return F.array_join(F.slice(found, at + 1, length), " ")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(grams, classes) of items (item_id, text).

    A gram (gram, h, length, class) is a window of ``window`` consecutive words of any
    item; an item of fewer words, but not none, is one window. Windows that occur in the
    same items share a class (class, items), the items being sorted as strings, each
    once. An item without an id has the empty string for one.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    cut = benchmark.select(item, words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    each = cut.select("item", "w", _hashes(F.col("w")).alias("hashes"), length.alias("length")).select(
        "item",
        "length",
        F.inline(
            F.transform(
                _places(F.size("w"), F.col("length")),
                lambda i: F.struct(
                    _text_of(F.col("w"), i, F.col("length")).alias("gram"),
                    _window_hash(F.col("hashes"), i, F.col("length"), window).alias("h"),
                ),
            )
        ),
    )
    owned = each.groupBy("gram", "h", "length").agg(F.sort_array(F.collect_set("item")).alias("items"))
    named = materialize(owned.withColumn("class", F.sha2(F.to_json("items"), 256)), "benchmark_windows")
    classes = named.select("class", "items").dropDuplicates(["class"])
    return named.drop("items"), materialize(classes, "benchmark_classes")


def _bit(h: Column, number: int) -> Column:
    """The place within a word of one of the bits that a hash sets."""
    return F.shiftrightunsigned(h, 6 * number).bitwiseAND(F.lit(WORD - 1)).cast("int")


def _word_at(h: Column, n_words: int) -> Column:
    return F.pmod(F.shiftright(h, 6 * BITS_SET), F.lit(n_words)).cast("int")


def _bit_words(grams: DataFrame, n_words: int) -> DataFrame:
    """A stored row with the words of a bit filter of the grams, combined in each task first."""
    mask = F.lit(0).cast("long")
    for number in range(BITS_SET):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("h"), number)))
    filled = grams.groupBy(_word_at(F.col("h"), n_words).alias("at")).agg(F.bit_or(mask).alias("bits"))
    every = grams.sparkSession.range(n_words).select(F.col("id").cast("int").alias("at"))
    both = every.join(filled, "at", "left").select("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    row = both.agg(F.sort_array(F.collect_list(F.struct("at", "bits"))).alias("all"))
    return materialize(row.select(F.col("all.bits").alias("bits")), "window_bits")


def _scan(docs: DataFrame, grams: DataFrame, count: int, lengths: list[int]) -> DataFrame:
    """(doc_id, row, n_words, found): windows (pos, length, gram) of each document that
    may be among ``grams``. Nothing leaves the row of the document."""
    n_words = max(1, math.ceil(count * BITS_EACH / WORD))
    bits = _bit_words(grams, n_words)

    def passes(h: Column) -> Column:
        def all_set(word: Column) -> Column:
            found = F.lit(True)
            for number in range(BITS_SET):
                found = found & (F.getbit(word, _bit(h, number)) == 1)
            return found

        # The column is named once, so that it is read in place and not copied to each row.
        return let(F.get("bits", _word_at(h, n_words)), all_set)

    def of_length(w: Column, hashes: Column, length: Column) -> Column:
        likely = F.filter(
            _places(F.size(w), length), lambda i: let(_window_hash(hashes, i, length, max(lengths)), passes)
        )
        return F.transform(
            likely, lambda i: F.struct(i.alias("pos"), length.alias("length"), _text_of(w, i, length).alias("gram"))
        )

    sizes = F.array(*[F.lit(n) for n in sorted(lengths)])

    def windows(w: Column) -> Column:
        found = let(_hashes(w), lambda hashes: F.flatten(F.transform(sizes, lambda length: of_length(w, hashes, length))))
        return F.struct(F.size(w).cast("long").alias("n_words"), found.alias("found"))

    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    scanned = keyed.withColumn("bits", bits.select("bits").scalar()).select(
        "doc_id", "row", let(words(F.col("text")), windows).alias("of")
    )
    return materialize(scanned.select("doc_id", "row", "of.n_words", "of.found"), "window_candidates")


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    scan_windows: int = SCAN_WINDOWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counted, hits, classes) for documents (doc_id, text).

    ``counted`` (doc_id, row, n_words) has every row of ``docs``; ``hits`` (doc_id, row,
    pos, length, class) the occurrences of benchmark windows, each verified as text. ``row``
    tells rows of one doc_id apart; equal rows have equal results.

    Windows that pass a test of bits meet the listed ones in a broadcast hash join by their
    text. At most ``scan_windows`` listed windows are tested in one scan, at most
    ``broadcast_bytes`` of their text are broadcast at a time; both are counted before.
    """
    grams, classes = benchmark_windows(benchmark, window)
    sizes = grams.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.octet_length("gram") + 128).alias("bytes")).collect()
    lengths = [r["length"] for r in sizes] or [window]
    count, size = sum(r["n"] for r in sizes), sum(r["bytes"] for r in sizes)
    scans = max(1, math.ceil(count / scan_windows))
    pieces = max(1, math.ceil(size / scans / broadcast_bytes))
    counted, hits = None, None
    part = F.pmod(F.hash("gram"), F.lit(scans * pieces))
    for scan in range(scans):
        some = grams.filter(part % scans == scan) if scans > 1 else grams
        scanned = _scan(docs, some, math.ceil(count / scans), lengths)
        if counted is None:
            counted = scanned.drop("found")
        likely = scanned.select("doc_id", "row", F.inline("found"))
        for piece in range(pieces):
            listed = some.filter(part == piece * scans + scan).select("gram", "class")
            met = likely.join(F.broadcast(listed), "gram").drop("gram")
            hits = met if hits is None else hits.unionByName(met)
    return counted, materialize(hits, "benchmark_hits"), classes


def hit_bitmaps(hits: DataFrame) -> DataFrame:
    """(doc_id, row, drops): sparse bitmaps of the words inside any occurrence of a window."""
    inside = F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("length") - 1)).alias("pos")
    return drop_bitmaps(hits.select("doc_id", "row", inside))


def hit_items(hits: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, members): (doc_id, row, set) by document, and (set, items) with the items of
    each set sorted as strings. Documents with the same passages share a set, so its
    items are gathered once; they are items of the benchmark, whatever the corpus."""
    by_doc = hits.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("class")).alias("classes"))
    sets = materialize(by_doc.withColumn("set", F.sha2(F.to_json("classes"), 256)), "class_sets")
    each = sets.dropDuplicates(["set"]).select("set", F.explode("classes").alias("class")).join(classes, "class")
    members = each.select("set", F.explode("items").alias("item")).groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return sets.drop("classes"), materialize(members, "set_items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, row, n_words, n_hit, items) for each row of ``docs``: its words, those
    inside an occurrence of a benchmark window, and the items with such windows.

    A null or wordless text has no words and no hits. An empty benchmark hits nothing.
    """
    counted, hits, classes = benchmark_hits(docs.select("doc_id", "text"), benchmark, window)
    sets, members = hit_items(hits, classes)
    n_hit = F.aggregate("drops", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"]))
    covered = hit_bitmaps(hits).select("doc_id", "row", n_hit.alias("n_hit"))
    found = materialize(covered.join(sets.withColumnRenamed("doc_id", "d").withColumnRenamed("row", "r"),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r"))).drop("d", "r"), "contaminated").join(members, "set")
    same = counted["doc_id"].eqNullSafe(found["doc_id"]) & (counted["row"] == found["row"])
    return counted.join(found, same, "left").select(
        counted["doc_id"],
        counted["row"],
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def text_without(text: Column, drops: Column) -> Column:
    """The text without the words set in the bitmap, each with the separators before it.
    All else stays as written."""

    def rest(w: Column, s: Column) -> Column:
        keep = F.array_except(_places(F.size(w), F.lit(1)), dropped_positions(drops))
        return F.concat(F.array_join(F.transform(keep, lambda i: F.concat(F.get(s, i), F.get(w, i))), ""), F.element_at(s, -1))

    own = F.array_remove(F.split(text, SEPARATORS_AS_WRITTEN, -1), "")
    between = F.split(text, WORDS_AS_WRITTEN, -1)
    return F.when(drops.isNull(), text).otherwise(let(own, lambda w: let(between, lambda s: rest(w, s))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "spans") -> DataFrame:
    """``docs`` without what the benchmark holds: of ``spans`` the words of each occurrence,
    of ``documents`` each row with an occurrence. Columns stay as they are; n_chars,
    where docs have it, is that of the new text. Null texts stay null."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is spans or documents")
    _, hits, _ = benchmark_hits(docs.select("doc_id", "text"), benchmark, window)
    bitmaps = materialize(hit_bitmaps(hits), "hit_words")
    rows = docs.select(F.struct("*").alias("doc"), row_key(docs["doc_id"], docs["text"]).alias("key"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("row"))
    if remove == "documents":
        return rows.join(bitmaps, same, "left_anti").select(*[F.col("doc")[c].alias(c) for c in docs.columns])
    text = text_without(F.col("doc.text"), F.col("drops"))
    inner = {c: F.col("doc")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        new = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        inner["n_chars"] = F.when(F.col("drops").isNull(), F.col("doc.n_chars")).otherwise(new)
    return rows.join(bitmaps, same, "left").select(*[c.alias(n) for n, c in inner.items()])
