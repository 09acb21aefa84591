from __future__ import annotations

import math

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.feature import HashingTF, IDF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallywright.functions import numbers, tokens
from tallywright.operators import features, indexing, lookup, ranking, text

RAISED = (PySparkException, Py4JJavaError)

TEXTS = [
    "Will never buy THIS again.",
    "two  spaces\tand\na line",
    " leading",
    "trailing  ",
    "   ",
    "",
    "the the The",
    "don't stop, me now",
    "Émile ÊTRE où ça",
    "non breaking",
    None,
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").filter("t is not null").persist()


def test_stop_words_are_those_of_spark(spark):
    assert list(tokens.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_words_are_those_of_the_transformers(posts):
    ours = text.with_filtered_words(text.with_words(posts, "t", "w"), "t", "f")
    theirs = text.ml_words(Tokenizer(inputCol="t", outputCol="w2").transform(ours), "t", "f2")
    for row in theirs.collect():
        assert row["w"] == row["w2"]
        assert row["f"] == row["f2"]


def test_words_of_null_are_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, t string")
    assert text.with_words(df, "t", "w").first()["w"] is None


def test_first_post(posts):
    row = text.with_filtered_words(posts, "t", "w").filter("id = 0").first()
    assert row["w"] == ["never", "buy", "again."]


def test_term_frequency_counts_each_word(spark, posts):
    words = text.with_words(posts, "t", "w")
    got = {(r["id"], r["term"]): r["tf"] for r in text.term_frequency(words, "id", "w").collect()}
    wanted = {}
    for row in words.collect():
        for word in row["w"]:
            if word:
                wanted[(row["id"], word)] = wanted.get((row["id"], word), 0) + 1
    assert got == wanted
    assert "Exchange" not in text.term_frequency(words, "id", "w")._jdf.queryExecution().executedPlan().toString()


def test_term_frequency_of_no_words(spark):
    df = spark.sql("select 1 as id, cast(array() as array<string>) as w union all select 2, array('')")
    assert text.term_frequency(df, "id", "w").count() == 0


def test_idf_is_that_of_the_estimator(posts):
    words = text.with_words(posts, "t", "w").withColumn("w", tokens.without_empty(F.col("w")))
    ours = {r["term"]: r["idf"] for r in text.idf_weights(words, "w").collect()}
    counts = HashingTF(inputCol="w", outputCol="c", numFeatures=1 << 20)
    weights = IDF(inputCol="c", outputCol="f").fit(counts.transform(words)).idf
    for term, value in ours.items():
        assert math.isclose(weights[counts.indexOf(term)], value, abs_tol=1e-12)


def test_tf_idf(spark, posts):
    words = text.with_filtered_words(posts, "t", "w")
    got = sorted(tuple(r) for r in text.tf_idf(words, "id", "w").collect())
    idf = {r["term"]: r["idf"] for r in text.idf_weights(words, "w").collect()}
    tf = text.term_frequency(words, "id", "w").collect()
    assert [(g[0], g[1], g[5]) for g in got] == sorted((r["id"], r["term"], r["tf"] * idf[r["term"]]) for r in tf)


def skewed(spark):
    """A third of all rows has the value h, the others are all different."""
    value = F.when(F.col("id") % 3 == 0, "h").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string"))
    return spark.range(9000).select("id", value.alias("v"))


def test_salted_join_is_whole_and_divides_the_hot_key(spark):
    df = skewed(spark)
    counts = df.filter("v is not null").groupBy("v").count().persist()
    joined = lookup.attach_lookup(df, counts, "v", "count", "id", rows_per_part=100)
    assert joined.count() == df.filter("v is not null").count()
    assert joined.filter("v = 'h' and count = 3000").count() == 3000
    left = lookup.attach_lookup(df, counts, "v", "count", "id", rows_per_part=100, how="left")
    assert left.count() == 9000
    assert left.filter("count is null").count() == df.filter("v is null").count()
    assert sorted(left.columns) == ["count", "id", "v"]
    # Salting is what spreads the hot key: its rows must not share one salt.
    sizes = df.filter("v = 'h'").groupBy(F.pmod(F.xxhash64("id"), F.lit(30))).count().collect()
    assert len(sizes) == 30 and max(r["count"] for r in sizes) < 150


@pytest.mark.parametrize("n", [0, 500, 150_000])
def test_numbers_are_consecutive(spark, n):
    df = spark.range(n).select(F.xxhash64("id").alias("k")).repartition(5)
    got = ranking.numbered(df, [F.asc("k")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(n))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)


def test_category_index_is_that_of_the_string_indexer(spark):
    df = skewed(spark).filter("v is not null")
    mapping = indexing.category_index(df, "v", "i")
    model = indexing.string_indexer(["v"], ["i"]).fit(df)
    assert [r["v"] for r in mapping.orderBy("i").collect()] == model.labels
    ours = indexing.apply_category_index(df, mapping, "v", "i", "id")
    theirs = model.transform(df)
    assert sorted(ours.select("id", "i").collect()) == sorted(theirs.select("id", "i").collect())


def test_unseen_values(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    rows = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, v string")
    mapping = indexing.category_index(train, "v", "i")
    keep = indexing.apply_category_index(rows, mapping, "v", "i", "id", "keep")
    assert {r["id"]: r["i"] for r in keep.collect()} == {1: 1.0, 2: 2.0, 3: 2.0}
    model = indexing.string_indexer(["v"], ["i"], "keep").fit(train)
    assert {r["id"]: r["i"] for r in model.transform(rows).collect()} == {1: 1.0, 2: 2.0, 3: 2.0}
    with pytest.raises(RAISED, match="no index for"):
        indexing.apply_category_index(rows, mapping, "v", "i", "id").collect()
    with pytest.raises(RAISED):
        indexing.string_indexer(["v"], ["i"]).fit(train).transform(rows).collect()


def test_one_term_in_nearly_all_rows(spark):
    text_of = F.when(F.col("id") % 10 != 0, F.lit("common")).otherwise(F.concat(F.lit("w"), F.col("id").cast("string")))
    words = spark.range(20_000).select("id", F.array(text_of).alias("w"))
    rows = text.tf_idf(words, "id", "w")
    assert rows.count() == 20_000
    assert rows.filter("term = 'common'").select("doc_freq").distinct().collect() == [(18_000,)]


def test_filled_buckets_do_not_leave_the_row_empty(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(5, {1: 2.0, 4: 1.0})), (2, Vectors.sparse(5, {}))], ["id", "c"])
    assert sorted(map(tuple, text.filled_buckets(df, "id", "c").collect())) == [(1, 1, 2.0), (1, 4, 1.0)]


def test_one_fit_indexes_all_columns(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y")], "p string, q string")
    model, indexed = indexing.index_columns(df, ["p", "q"])
    assert [list(labels) for labels in model.labelsArray] == [["a", "b"], ["y", "x"]]
    assert [(r["p_index"], r["q_index"]) for r in indexed.collect()] == [(0.0, 1.0), (0.0, 0.0), (1.0, 0.0)]


def test_one_hot_of_an_unknown_value_is_zero(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    _, indexed = indexing.index_columns(df, ["v"], handle_invalid="keep")
    _, encoded = indexing.one_hot(indexed, ["v_index"], ["vec"])
    assert [list(r["vec"].toArray()) for r in encoded.collect()] == [[1, 0], [1, 0], [0, 1], [0, 0]]


def test_labels_return_and_unknown_has_a_name(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (3.0,), (-1.0,), (None,)], "p double")
    back = indexing.index_to_label(df, "p", ["positive", "negative", "neutral"], "l")
    assert [r["l"] for r in back.collect()] == ["positive", "neutral", "__unknown", "__unknown", "__unknown"]


def test_assembler_on_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(RAISED):
        features.assemble(df, ["a", "b"]).collect()
    kept = features.assemble(df, ["a", "b"], handle_invalid="keep").first()["features"]
    assert kept[0] == 1.0 and math.isnan(kept[1])


def test_probability_of_a_class(spark):
    df = spark.createDataFrame([(Vectors.dense([0.25, 0.75]),)], ["probability"])
    assert df.select(numbers.class_probability("probability").alias("p")).first()["p"] == 0.75
    assert df.select(vector_to_array("probability")[0].alias("p")).first()["p"] == 0.25
