from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import oracle
from tallywright.llm import urls
from tallywright.llm.queries import OP4_SQL, RULES, op4_url_filters


def test_query_equals_sql(spark, sf_dir):
    assert oracle.compare(op4_url_filters(spark, sf_dir), oracle.connect(sf_dir), OP4_SQL) == []


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        (None, "", "", None),
        ("", "", "", None),
        ("example.com/en/", "", "", None),
        ("http://A.Example.COM/en/x?y://z/", "a.example.com", "/en/x", "example.com/en/"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
        ("http://x.www.example.com/en/#a", "x.www.example.com", "/en/", "www.example.com/en/"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/"),
        ("http://example.com?/en/", "example.com", "", None),
        ("http://example.com/EN/", "example.com", "/EN/", "com/"),
        ("ÉX://ÉX.net/es/a\nb?c", "Éx.net", "/es/a\nb", "net/es/"),
        ("line\nhttp://b.net/fr", "b.net", "/fr", None),
        ("a://b://c.com/", "b:", "//c.com/", None),
        ("http://" + "a" * 100_000 + ".com/", "a" * 100_000 + ".com", "/", "com/"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule):
    df = spark.createDataFrame([(url,)], "url string").select(
        urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")
    )
    row = df.withColumn("rule", urls.rule_name(RULES, F.col("host"), F.col("path"))).first()
    assert tuple(row) == (host, path, rule)


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


@pytest.mark.parametrize("listed", [0, 1, 40, 1500, 3000])
def test_exact_for_the_whole_universe(spark, listed):
    universe = [f"k{i}" for i in range(3000)]
    inside = {f"k{i}" for i in range(3000) if i * 7919 % 3000 < listed}
    cascade = urls.Cascade(keys(spark, [*universe, "k1", None]), keys(spark, [*inside, *inside, "elsewhere", None]))
    assert cascade.slices == 1 and len(cascade.cascades[0]) <= 20
    got = cascade.mark(keys(spark, [*universe, None, None]), "key", "in").collect()
    assert len(got) == 3002
    assert {r["key"] for r in got if r["in"]} == inside


@pytest.mark.parametrize("most_bits", [100, 1000, 1 << 20])
def test_slices(spark, most_bits):
    """Lists beyond the bound are marked by cascades of slices, exactly and without a join."""
    universe = [f"k{i}" for i in range(300)]
    cascade = urls.Cascade(keys(spark, universe), keys(spark, universe[:99]), most_bits)
    assert (cascade.slices > 1) == (most_bits < 1 << 20)
    rows = keys(spark, [*universe, "k1", None])
    marked = cascade.mark(rows, "key", "in")
    assert "Join" not in marked._jdf.queryExecution().executedPlan().toString()
    for got in (marked.collect(), rows.withColumn("in", cascade.inside(F.col("key"))).collect()):
        assert sorted(r["key"] for r in got if r["in"]) == sorted([*universe[:99], "k1"]) and len(got) == 302


def test_levels_of_many_keys(spark, monkeypatch):
    """Where bits are dear a cascade has the rates of a large one, and more levels."""
    monkeypatch.setattr(urls, "SMALL", 0)
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 20_000, 9).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = urls.Cascade(universe, listed)
    levels = cascade.cascades[0]
    assert len(levels) >= 6 and sum(level.bits for level in levels) < 12 * 2223
    got = cascade.mark(universe, "key", "in").filter("in").select("key")
    assert got.exceptAll(listed).count() == 0 and got.count() == 2223


def test_no_rows(spark):
    cascade = urls.Cascade(keys(spark, []), keys(spark, []))
    assert cascade.mark(keys(spark, ["a"]), "key", "in").first()["in"] is False
