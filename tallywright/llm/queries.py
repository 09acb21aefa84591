"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import (
    contamination,
    counts,
    lines,
    middle,
    packing,
    pieces,
    quality,
    resample,
    sharding,
    simhash,
    topk,
    urls,
    warc,
)
from tallywright.sources.scratch import materialize, scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, folder, "documents"), shingle=4, radius=4)
    return groups.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = materialize(quality.with_statistics(docs).select("doc_id", "stats"), "statistics")
    rules = quality.fit(stats, table(spark, folder, "labels"))
    return stats.select(
        "doc_id", "stats.*", quality.base_failed().alias("base_failed"), quality.verdict(rules).alias("kept")
    )


SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """A shard for every document, by its id."""
    docs = table(spark, folder, "documents").select("doc_id")
    return sharding.with_shard(docs, ["doc_id"], SHARDS)


RULES = urls.parse_rules(
    """
    allow com/
    block example.com/en/
    allow www.example.com/en/
    block net/es/
    block net/fr/
    """
)
# Symbols for 100 characters of html above which a page puts its address on the list.
SYMBOLS = 5


def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict of the rules, else block for an address (host and path) that is listed.
    The list has the addresses of pages full of symbols, as they are found in the table."""
    pages = table(spark, folder, "pages")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"), "html").withColumn(
        "key", F.concat("host", "path")
    )
    symbols = F.char_length(F.regexp_replace("html", "[^#*$%|]+", ""))
    listed = cut.filter(100 * symbols > SYMBOLS * F.char_length("html")).select("key")
    cascade = urls.Cascade(cut.select("key"), listed)
    marked = cascade.mark(cut.select("page_id", "host", "path", "key"), "key", "listed")
    rule = urls.rule_name(RULES, F.col("host"), F.col("path"))
    verdict = F.coalesce(urls.rule_verdict(RULES, F.col("rule")), F.when(F.col("listed"), "block").otherwise("allow"))
    return marked.withColumn("rule", rule).select("page_id", "host", "path", "rule", verdict.alias("verdict"))


OP4_SQL = r"""
with cut as (
    select page_id,
           translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path,
           100 * length(regexp_replace(html, '[^#*$%|]+', '', 'g')) > 5 * length(html) as full_of_symbols
    from pages),
rules(verdict, host, path) as (
    values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fitting as (
    select page_id, r.host || r.path as rule, r.verdict,
           row_number() over (partition by page_id order by length(r.host || r.path) desc) as place
    from cut join rules r
      on (cut.host = r.host or ends_with(cut.host, '.' || r.host)) and starts_with(cut.path, r.path)),
listed as (select distinct host || path as key from cut where full_of_symbols)
select cut.page_id, cut.host, cut.path, f.rule,
       coalesce(f.verdict, case when listed.key is not null then 'block' else 'allow' end) as verdict
from cut left join fitting f on cut.page_id = f.page_id and f.place = 1
     left join listed on listed.key = cut.host || cut.path
"""


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """A sampled segmentation of every document, by its id, and whether it spells the text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sampled = docs.withColumn("ids", pieces.encode(F.col("text"), "doc_id", seed=0, alpha=1.0))
    return sampled.select(
        "doc_id",
        F.size("ids").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        pieces.decode(F.col("ids")).eqNullSafe(F.col("text")).alias("lossless"),
    )


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    bitmaps = lines.line_bitmaps(docs, min_docs=5, min_chars=40)
    text, drops = F.col("doc.text"), F.col("drops")
    return lines.with_drops(docs, bitmaps).select(
        "doc.doc_id",
        F.size(lines.lines(text)).cast("long").alias("n_lines"),
        F.size(lines.dropped_positions(drops)).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(lines.kept_text(text, drops), F.lit("")), 256).alias("kept_sha256"),
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, without its separator, counted in flat token files."""
    return counts.document_token_counts(table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), capacity=1024)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of all pages are written to the shared folder and read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.page_records(spark, path, unreadable=True).drop("problem")


OP9_SQL = """
with digested as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
    from pages),
shared as (
    select payload_digest, max(page_id) as original from digested where payload_bytes >= 1000
    group by payload_digest having count(*) > 1)
select page_id, payload_bytes, d.payload_digest,
       case when original is not null and original <> page_id then 'revisit' else 'response' end as record_type,
       case when original <> page_id then original end as refers_to
from digested d left join shared s on d.payload_digest = s.payload_digest
"""


def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Scores are long, as in the SQL; one beyond that is an error there and here."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("components"))
    found = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, factor=256)
    return found.withColumn("score", F.col("score").cast("long"))


OP10_SQL = """
with part as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id,
           coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::hugeint as score
    from part q, part c where q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score::bigint as score from ranked where rank <= 5
"""
OP6_SQL = """
with cut as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents),
keyed as (
    select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key
    from cut),
shared as (
    select key, max(doc_id) as holder from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5),
marked as (
    select keyed.*, holder is not null and doc_id <> holder as gone from keyed left join shared using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination.contamination(docs, table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP11_SQL = r"""
with doc_words as (
    select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents),
item_words as (
    select item_id::varchar as item, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark),
item_places as (
    select item, w, least(len(w), 10) as size, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i
    from item_words where len(w) > 0),
grams as (select distinct item, size, array_to_string(w[i:i + size - 1], ' ') as gram from item_places),
doc_places as (
    select doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) as i
    from doc_words, (select distinct size from grams) where len(w) >= size),
doc_grams as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as gram from doc_places),
hits as (
    select doc_id, i, d.size from doc_grams d
    where exists (select 1 from grams g where g.gram = d.gram and g.size = d.size)),
covered as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(generate_series(i, i + size - 1)) as place from hits) group by doc_id),
found as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, item from doc_grams d join grams g on g.gram = d.gram and g.size = d.size) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join covered c on d.doc_id = c.doc_id left join found f on d.doc_id = f.doc_id
"""


def op12_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return middle.with_middle(docs).select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


OP12_SQL = """
with drawn as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
           sha256('1:' || coalesce(doc_id::varchar, '')) as h
    from documents),
numbers as (
    select *, ('0x' || h[1:8])::bigint % (n + 1) as a, ('0x' || h[9:16])::bigint % (n + 1) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                     or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
                when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form
    from drawn),
cut as (
    select *, substr(text, 1, least(a, b)) as prefix, substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) as middle,
           substr(text, greatest(a, b) + 1) as suffix
    from numbers)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then least(a, b)::bigint end as prefix_chars,
       case when form <> 'plain' then (greatest(a, b) - least(a, b))::bigint end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""


def op13_resample(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = resample.scored(docs, table(spark, folder, "benchmark").select("text"))
    return resample.ranked(rows).drop("row")


# CRC-32 byte by byte, by a table that the first steps make; 3988292384 is its reversed polynomial.
OP13_SQL = r"""
with recursive steps(byte, step, v) as (
    select i, 0, i::bigint from range(256) t(i) union all
    select byte, step + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from steps where step < 8),
crc_table as (select list(v order by byte) as entries from steps where step = 8),
cut as (
    select 'd' as side, row_number() over () as id, doc_id, text from documents union all
    select 't', row_number() over (), null, text from benchmark),
worded as (
    select side, id, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from cut),
placed as (select side, id, w, size, unnest(generate_series(1, len(w) - size + 1)) as i from worded, (values (1), (2), (3)) t(size)),
counted as (select side, id, array_to_string(w[i:i + size - 1], ' ') as run, count(*) as n from placed group by all),
spelt as (select run, hex(encode(run)) as h from (select distinct run from counted)),
hashed as (
    select run, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::bigint)),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from spelt, crc_table),
features as (select side, id, bucket, sum(n)::bigint as n from counted join hashed using (run) group by all),
totals as (
    select coalesce(sum(n) filter (where side = 'd'), 0)::double as s_all, coalesce(sum(n) filter (where side = 't'), 0)::double as t_all
    from features),
buckets as (
    select bucket, coalesce(sum(n) filter (where side = 'd'), 0)::double as s, coalesce(sum(n) filter (where side = 't'), 0)::double as t
    from features group by bucket),
gains as (
    select bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as gain from buckets, totals),
weights as (
    select id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from features join gains using (bucket)
    where side = 'd' group by id),
scored as (
    select doc_id, len(w) >= 20 as able, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::varchar, ''))[1:8])::bigint + 0.5::double)
                                                      / 4294967296.0::double)))::bigint as score
    from worded left join weights using (id) where side = 'd'),
ranked as (
    select *, row_number() over (partition by able order by score desc, doc_id, n_features) as place,
           (5 * count(*) filter (where able) over ()) // 100 as drawn
    from scored)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score,
       case when able and place <= drawn then place::bigint end as rank
from ranked
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_sharding": op3_sharding,
    "op4_url_filters": op4_url_filters,
    "op5_pieces": op5_pieces,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_top_k": op10_top_k,
    "op11_decontamination": op11_decontamination,
    "op12_middle": op12_middle,
    "op13_resample": op13_resample,
}
ORACLES: dict[str, str] = {
    "op4_url_filters": OP4_SQL,
    "op6_line_dedup": OP6_SQL,
    "op9_warc": OP9_SQL,
    "op10_top_k": OP10_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_middle": OP12_SQL,
    "op13_resample": OP13_SQL,
}
