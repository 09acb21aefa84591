from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import oracle
from tallywright.llm import warc
from tallywright.llm.queries import OP9_SQL, op9_warc


def test_query_equals_sql(spark, sf_dir):
    assert oracle.compare(op9_warc(spark, sf_dir), oracle.connect(sf_dir), OP9_SQL) == []


def slow(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        ids = [p for p in groups[body] if p is not None]
        shared = len(body) >= 1000 and len(groups[body]) > 1 and ids and page_id != max(ids)
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if shared else "response", max(ids) if shared else None, None))
    return sorted(out, key=str)


def test_given_pages_are_cut_into_segments(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    warc.write_archives(pages, str(tmp_path / "a"))
    kinds = {r["type"]: r["count"] for r in warc.read_records(spark, str(tmp_path / "a")).groupBy("type").count().collect()}
    assert kinds.get("continuation", 0) > 0


def odd_pages():
    long = "é😀\r\n\r\nWARC/1.1\r\n" * 30_000
    big, small = "x" * 1000, "y" * 999
    rows = [(i, f"http://a/{i}", big) for i in (5, 9, 7)] + [(i, None, small) for i in (1, 2)]
    rows += [(20, "http://a/\r\nX: y", None), (21, "", ""), (22, "é", long), (23, "http://b", long), (24, "u", long + "z")]
    rows += [(30, "r", "rep" * 400), (30, "r", "rep" * 400), (None, "n", big), (None, "m", "alone" * 300), (None, "m", "alone" * 300)]
    return rows + [(40, "0", "0\r\n\r\n"), (9, "again", "other " * 300), (-3, "neg", "w" * 2000), (-4, "neg", "w" * 2000)]


@pytest.mark.parametrize("segment, chunk", [(1 << 16, 1 << 14), (1000, 7)])
def test_odd_pages_make_the_round_trip(spark, tmp_path, segment, chunk, monkeypatch):
    rows = odd_pages()
    df = spark.createDataFrame([(*r, "t", b"x") for r in rows], "page_id long, url string, html string, type string, block binary")
    path = str(tmp_path / "archives")
    if segment == 1000:  # segments of another writer, cut anywhere, as plain files
        (tmp_path / "archives").mkdir()
        monkeypatch.setattr(warc, "SEGMENT", segment)
        texts = [t for i, (p, _, h) in enumerate(rows) for t in warc.record_texts(p, "u", (h or "").encode()[:90_000], hashlib.sha1((h or "").encode()[:90_000]).hexdigest(), None, i)]
        for n in range(3):  # continuations lie in other files than their origin, in any order
            (tmp_path / "archives" / f"{n}.warc").write_bytes(b"".join(t + b"\r\n\r\n" for t in texts[::-1][n::3]))
        got = warc.responses(warc.read_records(spark, path)).collect()
        assert all(r["problem"] is None for r in got)
        assert sorted(bytes(r["payload"]) for r in got) == sorted((h or "").encode()[:90_000] for _, _, h in rows)
        return
    warc.write_archives(df, path)
    got = warc.page_records(spark, path).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow(rows)


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"))
    assert warc.page_records(spark, str(tmp_path / "a")).count() == 0


def record(**fields):
    block = fields.pop("block")
    lines = ["WARC/1.1", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def test_what_is_not_whole_is_named(spark, tmp_path):
    body = warc.HTTP + warc.framed(b"abc" * 100, 50)
    parts = [body[:100], body[100:200], body[200:]]

    def segments(name, keep, total=len(body)):
        out = []
        for n in keep:
            first = {"WARC_Type": "response", "WARC_Record_ID": f"<{name}>"}
            later = {"WARC_Type": "continuation", "WARC_Record_ID": f"<{name}:{n}>", "WARC_Segment_Origin_ID": f"<{name}>"}
            last = {"WARC_Segment_Total_Length": total} if n == 3 else {}
            out.append(record(**(first if n == 1 else later), WARC_Segment_Number=n, **last, block=parts[n - 1]))
        return b"".join(out)

    def response(name, block, **more):
        return record(WARC_Type="response", WARC_Record_ID=f"<{name}>", **more, block=block)

    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a").write_bytes(
        segments("whole", [3, 1, 2, 2]) + segments("gap", [1, 3]) + segments("headless", [2, 3]) + segments("short", [1, 2, 3], 7)
        + segments("endless", [1, 2]) + response("plain", b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi")
        + response("less", b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nhi") + response("cut", body[:-20])
        + response("forged", body, WARC_Payload_Digest="sha1:00")
        + response("extended", warc.HTTP + b"2;a=b\r\nhi\r\n0\r\nTrailer: x\r\n\r\n")
        + record(WARC_Type="warcinfo", WARC_Record_ID="<i>", block=b"software: x")
    )
    (folder / "b").write_bytes(response("before", body) + b"WARC/1.1\r\nContent-Length: 99\r\n\r\nend")
    records = warc.read_records(spark, str(folder)).cache()
    assert records.filter("problem like 'unreadable%'").count() == 1
    got = {r["record_id"]: (r["payload"] and bytes(r["payload"]), r["problem"] is None) for r in warc.responses(records).collect()}
    pages = warc.page_records(spark, str(folder)).collect()
    assert sum(r["problem"] is None for r in pages) == 4 and sum(r["problem"] is not None for r in pages) == 7
    right = {"whole": b"abc" * 100, "plain": b"hi", "extended": b"hi", "before": b"abc" * 100}
    assert got == {k: (v, True) for k, v in right.items()} | {k: (None, False) for k in ("gap", "headless", "short", "endless", "less", "cut", "forged")}


def test_archives_of_others_lose_no_records(spark, tmp_path):
    """Unreadable stretches are named, reading goes on behind them, and digests may be base32."""
    body = b"abc" * 100
    block = warc.HTTP + warc.framed(body)
    sha1 = hashlib.sha1(body)
    digests = ["sha1:" + base64.b32encode(sha1.digest()).decode(), "SHA1:" + sha1.hexdigest().upper(), "sha1:" + sha1.hexdigest()]
    wrong = "sha1:" + base64.b32encode(bytes(20)).decode()

    def response(number, digest):
        return record(WARC_Type="response", WARC_Record_ID=f"<r{number}>", Page_ID=number, WARC_Payload_Digest=digest, block=block)

    whole = [response(n, d) for n, d in enumerate([*digests, wrong])]
    revisit = record(WARC_Type="revisit", WARC_Record_ID="<v>", Page_ID=9, WARC_Refers_To="<urn:page:2>", WARC_Payload_Digest=digests[0], block=b"")
    (tmp_path / "w").mkdir()
    broken = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"
    data = whole[0] + broken + whole[1] + b"noise without a head\r\n" + whole[2] + whole[3] + revisit + whole[0][:-30]
    (tmp_path / "w" / "a").write_bytes(data)
    (tmp_path / "w" / "b").write_bytes(b"nothing")
    got = [tuple(r) for r in warc.page_records(spark, str(tmp_path / "w"), unreadable=True).collect()]
    right = [(n, 300, sha1.hexdigest(), "response", None, None) for n in range(3)]
    right += [(3, None, None, "response", None, "digest"), (9, 300, sha1.hexdigest(), "revisit", 2, None)]
    assert sorted((r for r in got if r[3] != "unreadable"), key=str) == sorted(right, key=str)
    lost = [r for r in got if r[3] == "unreadable"]
    assert len(lost) == 4 and all(r[:3] == (None, None, None) and r[5].startswith("unreadable: ") for r in lost)


def test_transfer_codings():
    body = b"text " * 50
    head = b"HTTP/1.1 200 OK\r\n"
    framed = warc.framed(body)

    def payload(fields, data):
        return warc.payload_of(head + fields + b"\r\n\r\n" + data)

    assert payload(b"Transfer-Encoding:\tchunked", framed) == body
    assert payload(b"transfer-ENCODING :  Chunked \t", framed) == body
    assert payload(b"Transfer-Encoding: gzip, chunked", warc.framed(gzip.compress(body))) == body
    assert payload(b"Transfer-Encoding: gzip\r\nTransfer-Encoding: chunked", warc.framed(gzip.compress(body))) == body
    assert payload(b"Transfer-Encoding: deflate,chunked", warc.framed(zlib.compress(body))) == body
    assert payload(b"Transfer-Encoding: identity\r\nContent-Length: 250", body) == body
    assert payload(b"Content-Encoding: gzip", gzip.compress(body)) == gzip.compress(body)  # that is the entity's own
    assert warc.payload_of(b"20000101 host A 10.0.0.1") == b"20000101 host A 10.0.0.1"
    for fields, data in [
        (b"Transfer-Encoding: chunked, br", framed), (b"Transfer-Encoding: gzip, chunked", framed), (b"Content-Length: \xb2", b"ab"),
        (b"Content-Length: 1_0", b"a" * 10), (b"Transfer-Encoding: gzip", gzip.compress(body)[:-9]), (b"Transfer-Encoding: chunked", b"-1\r\n"),
    ]:
        with pytest.raises(ValueError):
            payload(fields, data)


def test_declared_digests():
    body = b"some payload"
    for name, spelt in (("sha1", "SHA-1"), ("md5", "md5"), ("sha256", "sha-256"), ("sha512", "sha512")):
        raw = hashlib.new(name, body).digest()
        for text in (raw.hex(), raw.hex().upper(), base64.b32encode(raw).decode(), base64.b32encode(raw).decode().rstrip("="), base64.b64encode(raw).decode()):
            found = warc.declared_digest(f"{spelt}:{text}")
            assert found == (raw.hex() if name == "sha1" else f"{name}:{raw.hex()}")
            assert warc.has_digest(body, found) and not warc.has_digest(b"other", found)
    assert warc.declared_digest("blake3:00ff") is None and warc.declared_digest(None) is None and warc.has_digest(body, None)
    for bad in ("sha1:00", "sha256:zz", "\u00e9" * 32, "sha1:" + "\u0661" * 40):
        assert not warc.has_digest(body, warc.declared_digest(bad))


def test_numbers_that_are_none(spark, tmp_path):
    """Odd numbers and segments without one give rows with problems, and no task fails."""
    block = warc.HTTP + warc.framed(b"abc" * 100)

    def first(name, number, **more):
        return record(WARC_Type="response", WARC_Record_ID=f"<{name}>", WARC_Segment_Number=number, **more, block=block[:50])

    def later(name, **more):
        return record(WARC_Type="continuation", WARC_Record_ID=f"<{name}:2>", WARC_Segment_Origin_ID=f"<{name}>", **more, block=block[50:])

    total = {"WARC_Segment_Total_Length": len(block)}
    data = [
        first("whole", 1) + later("whole", WARC_Segment_Number=2, **total),
        first("nameless", 1) + later("nameless", **total),
        first("mixed", 1) + later("mixed", WARC_Segment_Number=2, **total) + later("mixed", **total),
        first("square", "\u00b2"), first("large", "9" * 30), first("int", 1 << 40), first("arabic", "\u0661"),
        first("length", 1) + later("length", WARC_Segment_Number=2, WARC_Segment_Total_Length="1e3"),
        record(WARC_Type="response", WARC_Record_ID="<page>", Page_ID="9" * 25, block=block),
        record(WARC_Type="revisit", WARC_Record_ID="<v>", WARC_Refers_To="<urn:page>", block=b""),
        record(WARC_Type="revisit", WARC_Record_ID="<v>", WARC_Refers_To="<urn:page:" + "9" * 25 + ">", block=b""),
    ]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a").write_bytes(b"".join(data))
    got = warc.page_records(spark, str(tmp_path / "w"), unreadable=True).collect()
    assert sorted((r["record_type"], r["problem"] is None) for r in got) == [("response", False)] * 7 + [("response", True)] * 2 + [("revisit", False)] * 2
    named = warc.responses(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert {r["record_id"] for r in named if r["problem"] is None} == {"whole", "page"} and len(named) == 9


def test_compressed_archives(spark, tmp_path):
    """A member for each record or for many; a broken one is named and the next ones are read."""
    block = warc.HTTP + warc.framed(b"abc" * 100)
    records = [record(WARC_Type="response", WARC_Record_ID=f"<r{n}>", Page_ID=n, block=block) for n in range(6)]
    revisit = record(WARC_Type="revisit", WARC_Record_ID="<v>", Page_ID=9, WARC_Refers_To="<urn:page:4>", WARC_Payload_Digest="sha256:" + hashlib.sha256(b"abc" * 100).hexdigest(), block=b"")
    named = record(WARC_Type="response", WARC_Record_ID="<r4>", Page_ID=4, WARC_Payload_Digest="sha256:" + hashlib.sha256(b"abc" * 100).hexdigest(), block=block)
    broken = bytearray(gzip.compress(records[5]))
    broken[len(broken) // 2] ^= 0xFF
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(gzip.compress(records[0]) + gzip.compress(records[1] + records[2]) + bytes(broken) + gzip.compress(records[3]) + b"tail")
    (tmp_path / "w" / "b.warc.gz").write_bytes(gzip.compress(named) + gzip.compress(revisit) + gzip.compress(records[5])[:-4])
    got = warc.page_records(spark, str(tmp_path / "w"), unreadable=True).collect()
    assert sorted(r["page_id"] for r in got if r["record_type"] == "response" and r["problem"] is None) == [0, 1, 2, 3, 4]
    assert [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["problem"]) for r in got if r["record_type"] == "revisit"] == [(9, 300, hashlib.sha1(b"abc" * 100).hexdigest(), None)]
    assert sum(r["record_type"] == "unreadable" for r in got) >= 3


def test_damaged_archives_end_no_task(spark, tmp_path):
    """Bytes changed, left out and put in anywhere, plain and compressed: every file gives rows
    or names, and what lies outside the damage is read."""
    rng = random.Random(5)
    block = warc.HTTP + warc.framed(b"abc" * 40, 30)
    good = [record(WARC_Type="response", WARC_Record_ID=f"<r{n}>", Page_ID=n, WARC_Payload_Digest="sha1:" + hashlib.sha1(b"abc" * 40).hexdigest(), block=block) for n in range(4)]
    cut = [
        record(WARC_Type="response", WARC_Record_ID="<s>", Page_ID=7, WARC_Segment_Number=1, block=block[:60]),
        record(WARC_Type="continuation", WARC_Record_ID="<s:2>", WARC_Segment_Origin_ID="<s>", WARC_Segment_Number=2, WARC_Segment_Total_Length=len(block), block=block[60:]),
    ]
    odd = [b"\x00", b"\xff\xfe", b"\r\n\r\n", b"WARC/1.1\r\n", "\u00b2".encode(), b":", b"-1", b"9" * 40, b"\x1f\x8b\x08", b""]
    (tmp_path / "w").mkdir()
    for number in range(120):
        data = bytearray(b"".join(good[:3] + cut))
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(data))
            data[at : at + rng.randint(0, 12)] = rng.choice(odd)
        data = bytes(data) + b"\r\n\r\n" + good[3]
        if number % 3 == 0:
            data = bytearray(b"".join(map(gzip.compress, [*good[:3], *cut])))
            data[rng.randrange(len(data))] ^= 1 << rng.randrange(8)
            data = bytes(data) + gzip.compress(good[3])
        (tmp_path / "w" / f"{number}").write_bytes(data)
    got = warc.page_records(spark, str(tmp_path / "w"), unreadable=True).collect()
    last = [r for r in got if r["page_id"] == 3 and r["problem"] is None]
    assert len(last) >= 110
    assert all(r["payload_digest"] == hashlib.sha1(b"abc" * 40).hexdigest() for r in got if r["record_type"] == "response" and r["problem"] is None and r["page_id"] == 3)
