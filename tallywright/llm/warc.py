"""WARC archives: records written and read as plain files, segments reassembled."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize

VERSION = "WARC/1.1"
LINE = "\r\n"
# A block is cut into segments of this many bytes: fewer than many pages have.
SEGMENT = 1 << 14
# Records of one file. With the length of a segment it bounds what a reader holds.
FILE_RECORDS = 4000
# Bytes of one chunk of the transfer framing.
CHUNK = 1 << 14
DATE = "2000-01-01T00:00:00Z"
MIN_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

READ = (
    "path string, start long, type string, record_id string, target_uri string, page_id long, refers_to long, "
    "payload_digest string, segment int, origin_id string, total_length long, problem string, block binary"
)


# Bytes that a task gathers before it hands rows on.
BATCH = 1 << 23
KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows of a flat schema in batches; only their binary values count as size."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    part: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*part), kinds)], list(names))

    for row in rows:
        part.append(row)
        held += sum(len(x) for x in row if isinstance(x, bytes)) + 64
        if held > BATCH:
            yield out()
            part, held = [], 0
    if part:
        yield out()


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))


def framed(body: bytes, size: int = CHUNK) -> bytes:
    """The body in chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in (body[i : i + size] for i in range(0, len(body), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unframed(data: bytes) -> bytes:
    """The body of chunked transfer framing; chunk extensions and trailers are passed over.
    Raises ValueError if the framing is broken or ends too early."""
    parts, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        digits = data[at:end].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("chunk size")
        size = int(digits, 16)
        if not size:
            return b"".join(parts)
        part = data[end + 2 : end + 2 + size]
        at = end + 2 + size
        if len(part) != size or data[at : at + 2] != b"\r\n":
            raise ValueError("chunk end")
        parts.append(part)
        at += 2


def inflated(data: bytes, window: int) -> tuple[bytes, bytes]:
    """One compressed stream at the beginning of ``data``, and what follows it. The window
    is that of ``zlib``: 31 for gzip, 47 for either that or zlib. ValueError if it is broken."""
    stream = zlib.decompressobj(window)
    try:
        out = stream.decompress(data) + stream.flush()
    except zlib.error as error:
        raise ValueError("compressed data") from error
    if not stream.eof:
        raise ValueError("compressed data end early")
    return out, stream.unused_data


def payload_of(block: bytes) -> bytes:
    """The entity of an HTTP response without its transfer codings; ValueError if it is
    broken or has a coding that is not known. A block of another protocol is its payload."""
    if not block.startswith(b"HTTP/"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    fields = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])]
    codings = [c.strip().lower() for k, v in fields if k == b"transfer-encoding" for c in v.split(b",")]
    codings = [c for c in codings if c not in (b"", b"identity")]
    for coding in reversed(codings):  # the last one was put on last
        if coding == b"chunked":
            body = unframed(body)
        elif coding in (b"gzip", b"x-gzip", b"deflate"):
            body = inflated(body, 47)[0]
        else:
            raise ValueError("transfer coding")
    length = [v for k, v in fields if k == b"content-length"]
    if length and not codings and whole_number(length[0].decode("latin-1")) != len(body):
        raise ValueError("content length")
    return body


def whole_number(text: str, bits: int = 64) -> int | None:
    """The number of some ASCII digits with or without a sign; null of any other text and of
    one that does not fit."""
    if not re.fullmatch(r"[+-]?[0-9]{1,19}", text.strip(), re.ASCII):
        return None
    number = int(text)
    return number if -(1 << (bits - 1)) <= number < 1 << (bits - 1) else None


def originals(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(digest, original): the largest page_id of each payload of ``min_revisit`` bytes or
    more that several rows hold. Rows are combined in each task before the shuffle."""
    held = pages.filter(F.col("payload_bytes") >= min_revisit)
    found = held.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    return found.filter("n > 1 and original is not null").select(F.col("payload_digest").alias("digest"), "original")


def _clean(value: Column) -> Column:
    """Fit for a header field: without control characters; empty for a null."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\x00-\x1F\x7F]+", " ")


def record_texts(page_id: int | None, uri: str, payload: bytes | None, digest: str, refers_to: int | None, row: int) -> list[bytes]:
    """The record of a page, or the segments of one, without the closing empty lines."""
    shown = "" if page_id is None else page_id
    name = f"urn:page:{shown}:{row}"
    common = [f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"Page-ID: {shown}"]
    if refers_to is not None:
        fields = [
            VERSION, "WARC-Type: revisit", f"WARC-Record-ID: <{name}>", *common, f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>", "Content-Length: 0",
        ]
        return [LINE.join([*fields, "", ""]).encode()]
    block = HTTP + framed(payload or b"")
    parts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    out = []
    for number, part in enumerate(parts, 1):
        if number == 1:
            fields = ["WARC-Type: response", f"WARC-Record-ID: <{name}>", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
        else:
            fields = ["WARC-Type: continuation", f"WARC-Record-ID: <{name}:{number}>", f"WARC-Segment-Origin-ID: <{name}>"]
        if len(parts) > 1:
            fields.append(f"WARC-Segment-Number: {number}")
            if number == len(parts):
                fields.append(f"WARC-Segment-Total-Length: {len(block)}")
        out.append(LINE.join([VERSION, *fields, *common, f"Content-Length: {len(part)}", "", ""]).encode() + part)
    return out


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(((text,) for row in _tuples(batches) for text in record_texts(*row)), "value binary")


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """One WARC record for each row of ``pages`` (page_id, url, html), in plain archives
    below ``path``: files of whole records, each closed by two empty lines.

    Of rows with equal payloads of ``min_revisit`` bytes or more those with the largest
    page_id are responses, and the others are revisits that refer to it. Smaller ones
    are all responses. A null html is an empty payload; among equal payloads a row
    without a page_id revisits, but rows which are all without one are responses. A row
    that is repeated is written each time. Only identical payloads meet in a shuffle,
    as one row of counts each.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digested = pages.select("page_id", "url", html.alias("payload")).withColumns(
        {"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload")}
    )
    shared = materialize(originals(digested.drop("url"), min_revisit), "originals")
    other = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    rows = digested.join(shared, F.col("payload_digest") == F.col("digest"), "left").select(
        "page_id",
        _clean(F.col("url")).alias("url"),
        F.when(~other, F.col("payload")).alias("payload"),
        "payload_digest",
        F.when(other, F.col("original")).alias("refers_to"),
        F.monotonically_increasing_id().alias("row"),
    )
    # The text writer puts the bytes of a value and then the separator: the end of a WARC record.
    records = rows.mapInArrow(_records, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", LINE * 2).option("maxRecordsPerFile", FILE_RECORDS).mode("overwrite").text(path)


GZIP = b"\x1f\x8b\x08"
# A record begins at a line of its version.
BEGIN = re.compile(rb"\nWARC/\d")


# Digests that can be checked, and their bytes.
DIGESTS = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}


def declared_digest(declared: str | None) -> str | None:
    """A declared digest as lower-case hex, of any but SHA-1 behind its name and a colon. It may
    be in hex, base32 or base64 and without a name that of SHA-1. Null where there is none or
    one of another kind; a text that no payload has where it is not of its kind's length."""
    name, colon, value = (declared or "").strip().rpartition(":")
    name = name.strip().lower().replace("-", "").replace("_", "") if colon else "sha1"
    size = DIGESTS.get(name)
    if size is None or not value:
        return None
    found = None
    if len(value) == 2 * size and re.fullmatch("[0-9A-Fa-f]+", value):
        found = value.lower()
    else:
        padded = value.rstrip("=")
        for decode, unit in ((base64.b32decode, 8), (base64.b64decode, 4)):
            text = padded.upper() if unit == 8 else padded.replace("-", "+").replace("_", "/")
            try:
                raw = decode(text + "=" * (-len(text) % unit))
            except ValueError:
                continue
            if len(raw) == size:
                found = raw.hex()
                break
    if found is None:
        return f"{name}:malformed"
    return found if name == "sha1" else f"{name}:{found}"


def has_digest(payload: bytes, declared: str | None) -> bool:
    """Whether a payload has the digest that ``declared_digest`` gave; true where there is none."""
    if declared is None:
        return True
    name, colon, value = declared.rpartition(":")
    return hashlib.new(name if colon else "sha1", payload).hexdigest() == value


def members(data: bytes) -> Iterator[tuple[int, bytes | str]]:
    """(offset, bytes) of each part of an archive: of a plain one the whole, of a compressed one
    its gzip members one after another. A member that is broken is a text that says so, and
    reading goes on where the next one seems to begin."""
    if not data.startswith(GZIP):
        yield 0, data
        return
    at = 0
    while at < len(data):
        try:
            part, rest = inflated(data[at:], 31)
        except ValueError as error:
            yield at, str(error)
            at = data.find(GZIP, at + 1)
            if at < 0:
                return
            continue
        yield at, part
        at = len(data) - len(rest)
        if rest and not rest.startswith(GZIP):
            yield at, "no compressed data"
            at = data.find(GZIP, at + 1)
            if at < 0:
                return


def parse(path: str, content: bytes) -> Iterator[tuple]:
    """The records of one archive, plain or compressed, by their Content-Length. For what
    cannot be parsed there is a row that names the problem; reading goes on at the next line
    that begins a record. The start of a record of a compressed archive is that of its member."""
    for offset, part in members(content):
        if isinstance(part, str):
            yield unreadable(path, offset, part)
        else:
            plain = part is content
            for row in parse_plain(path, part):
                yield row if plain else (row[0], offset, *row[2:])


def unreadable(path: str, at: int, problem: object) -> tuple:
    return (path, at, *[None] * 9, f"unreadable: {problem}", None)


def parse_plain(path: str, data: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        try:
            end = data.index(b"\r\n\r\n", at)
            version, *fields = data[at:end].decode("utf-8", "replace").split(LINE)
            head = {k.strip().lower(): v.strip() for k, _, v in (f.partition(":") for f in fields)}
            size = whole_number(head["content-length"])
            if size is None or size < 0:
                raise ValueError("record length")
            block = data[end + 4 : end + 4 + size]
            stop = end + 4 + size
            if not version.startswith("WARC/") or len(block) != size or data[stop : stop + 4] != b"\r\n\r\n":
                raise ValueError("record end")
        except (ValueError, KeyError) as error:
            yield unreadable(path, at, error)
            following = BEGIN.search(data, at)
            if following is None:
                return
            at = following.start() + 1
            continue

        def number(name: str, bits: int = 64) -> int | None:
            return whole_number(head.get(name, ""), bits)

        def bare(name: str) -> str | None:
            return head[name].strip("<>") if name in head else None

        refers = re.fullmatch(r"urn:page:(.*)", bare("warc-refers-to") or "", re.DOTALL)
        segment, total = number("warc-segment-number", 32), number("warc-segment-total-length")
        problem = None
        if segment is None and "warc-segment-number" in head:
            problem = "segment number"
        elif total is None and "warc-segment-total-length" in head:
            problem = "total length"
        yield (
            path, at, head.get("warc-type"), bare("warc-record-id"), head.get("warc-target-uri"), number("page-id"),
            whole_number(refers[1]) if refers else None,
            declared_digest(head.get("warc-payload-digest")), segment,
            bare("warc-segment-origin-id"), total, problem, block,
        )
        at = stop + 4


def _read(spark: SparkSession, path: str, each: Callable[[tuple], tuple], schema: str) -> DataFrame:
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = ((b.column(0)[i].as_py(), b.column(1)[i].as_py()) for b in batches for i in range(b.num_rows))
        return _batches((each(row) for file in files for row in parse(*file)), schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(records, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, one row each with its block. Files are
    read whole, so they should be of some ten or hundred MB."""
    return _read(spark, path, lambda row: row, READ)


def _summary(row: tuple) -> tuple:
    """A record with the length and digest of its payload in place of its block, where it is
    a response of one part; a segment keeps its block."""
    kind, segment, block = row[2], row[8], row[12]
    if kind != "response" or segment is not None:
        return *row[:12], block if kind in ("response", "continuation") else None, None, None
    try:
        if row[11] is not None:
            raise ValueError(row[11])
        payload = payload_of(block)
    except ValueError as error:
        return *row[:11], str(error), None, None, None
    if not has_digest(payload, row[7]):
        return *row[:11], "digest", None, None, None
    return *row[:12], None, len(payload), hashlib.sha1(payload).hexdigest()


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path`` without what is not needed to judge them:
    only segments, which must meet others first, have a block."""
    return _read(spark, path, _summary, f"{READ}, payload_bytes long, digest string")


def joined(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """A block from its (number, total length or None, part); the numbers must run from 1
    without a gap, and the length must be what the last one says. A segment that was
    read twice counts once."""
    parts: dict[int, tuple[int | None, bytes]] = {}
    for number, total, part in segments:
        if number is None:
            raise ValueError("segment number")
        if parts.setdefault(number, (total, part)) != (total, part):
            raise ValueError("two segments of one number")
    if sorted(parts) != list(range(1, len(parts) + 1)):
        raise ValueError("a segment is missing")
    block = b"".join(parts[n][1] for n in sorted(parts))
    if parts[len(parts)][0] != len(block):
        raise ValueError("total length")
    return block


RESPONSE = "record_id string, target_uri string, page_id long, declared_digest string, payload binary, problem string"


def responses(records: DataFrame) -> DataFrame:
    """(record_id, target_uri, page_id, declared_digest, payload, problem) of each response.

    Only records in segments are shuffled: they are grouped by the id of the first one,
    sorted by number and joined one record at a time. A record whose segments or
    framing are not whole has a null payload and names the problem, and so does one
    whose payload has another digest than it declares.
    """

    def one(rows: list[tuple]) -> tuple:
        first = next((r for r in rows if r[1] == "response"), rows[0])
        _, kind, record_id, uri, page_id, declared, segment, origin, _, block, problem = first
        name = record_id if kind == "response" else origin
        try:
            if problem is not None:
                raise ValueError(problem)
            if segment is not None or kind != "response":
                block = joined([(r[6], r[8], r[9]) for r in rows])
            payload = payload_of(block)
            if not has_digest(payload, declared):
                raise ValueError("digest")
        except ValueError as error:
            return name, uri, page_id, declared, None, str(error)
        return name, uri, page_id, declared, payload, None

    def groups(rows: Iterator[tuple]) -> Iterator[tuple]:
        group: list[tuple] = []
        for row in rows:
            if group and (row[0] is None or row[0] != group[0][0]):
                yield one(group)
                group = []
            group.append(row)
        if group:
            yield one(group)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(groups(_tuples(batches)), RESPONSE)

    columns = ["type", "record_id", "target_uri", "page_id", "payload_digest", "segment", "origin_id", "total_length", "block", "problem"]
    whole = records.filter("type = 'response' and segment is null").select(F.lit(None).cast("string").alias("origin"), *columns)
    origin = F.when(F.col("type") == "continuation", F.col("origin_id")).otherwise(F.col("record_id"))
    cut = records.filter("type = 'continuation' or type = 'response' and segment is not null").select(origin.alias("origin"), *columns)
    sorted_cut = cut.repartition("origin").sortWithinPartitions("origin", "segment")
    return whole.mapInArrow(decode, RESPONSE).unionByName(sorted_cut.mapInArrow(decode, RESPONSE))


def page_records(spark: SparkSession, path: str, unreadable: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, problem) of each
    response and revisit in the archives below ``path``. The digest and length of a
    response are those of the payload read; a revisit has those of the response that it
    refers to, and a problem where there is none of its digest. With ``unreadable`` a
    stretch of a file that cannot be parsed is a row of that record type with its problem,
    all else null. The archives are read once.
    """
    records = materialize(read_summaries(spark, path), "records")
    whole = records.filter("type = 'response' and segment is null").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "problem", F.col("payload_digest").alias("declared")
    )
    cut = responses(records.filter("type = 'continuation' or segment is not null")).select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "problem",
        F.col("declared_digest").alias("declared"),
    )
    read = whole.unionByName(materialize(cut, "reassembled"))
    # A response is known by its SHA-1 and by the digest that it declares.
    names = F.explode(F.array_distinct(F.array_compact(F.array("payload_digest", "declared")))).alias("digest")
    seen = read.filter("problem is null").select("page_id", names, "payload_digest", "payload_bytes")
    there = materialize(
        seen.groupBy(F.col("page_id").alias("original"), "digest").agg(F.min("payload_digest").alias("sha1"), F.max("payload_bytes").alias("payload_bytes")),
        "originals_read",
    )
    asked = records.filter("type = 'revisit'").select("page_id", "payload_digest", "refers_to")
    # Both sides are plain rows, so that Spark can divide the revisits of one response.
    found = asked.join(there, (F.col("refers_to") == F.col("original")) & (F.col("payload_digest") == F.col("digest")), "left")
    revisits = found.select(
        "page_id",
        "payload_bytes",
        F.coalesce("sha1", "payload_digest").alias("payload_digest"),
        F.lit("revisit").alias("record_type"),
        "refers_to",
        F.when(F.col("original").isNull(), "no response").alias("problem"),
    )
    own = read.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "problem"
    )
    lost = records.filter("problem like 'unreadable:%'").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("unreadable").alias("record_type"), "refers_to", "problem"
    )
    every = own.unionByName(revisits)
    return every.unionByName(lost) if unreadable else every
