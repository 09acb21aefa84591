"""Scores recomputed from what a fitted model consists of, beside the model's own."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tallywright.operators import indexing, linear, models, recommend, text, trees, tuning


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(600).select(
        n.alias("key"),
        F.concat(F.lit("c"), (n % 9).cast("string")).alias("category"),
        F.concat(F.lit("f"), (n % 2).cast("string")).alias("flag"),
        (F.abs(F.hash(n)) % 100).cast("double").alias("x"),
        ((n % 9 < 4) | (F.abs(F.hash(n)) % 100 > 80)).cast("int").alias("label"),
        (F.abs(F.hash(n)) % 100 + (n % 9) * 10).cast("double").alias("price"),
    ).cache()


def encoded(rows):
    stages = [
        StringIndexer(inputCols=["category", "flag"], outputCols=["ci", "fi"]),
        OneHotEncoder(inputCols=["fi"], outputCols=["fv"], dropLast=False),
        VectorAssembler(inputCols=["ci", "x", "fv"], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(rows).transform(rows)


@pytest.mark.parametrize("depth", [0, 1, 6])
def test_forest_classifier(rows, depth):
    df = encoded(rows)
    model = RandomForestClassifier(labelCol="label", numTrees=7, maxDepth=depth, seed=3).fit(df)
    scored = trees.with_tree_probability(model.transform(df), model, "again")
    off = F.max(F.abs(F.col("again") - vector_to_array("probability")[1]))
    assert scored.agg(off).first()[0] < 1e-12
    nodes = trees.tree_nodes(df, model)
    assert nodes.select("tree").distinct().count() == 7
    if depth > 1:
        assert {r["categorical"] for r in nodes.filter("left >= 0").collect()} == {True, False}


def test_forest_regressor_and_a_wrong_score(rows):
    df = encoded(rows)
    model = RandomForestRegressor(labelCol="price", numTrees=5, maxDepth=4, seed=3).fit(df)
    scored = trees.with_tree_prediction(model.transform(df), model, "again")
    assert scored.filter(F.abs(F.col("again") - F.col("prediction")) > 1e-9).count() == 0
    other = RandomForestRegressor(labelCol="price", numTrees=5, maxDepth=4, seed=4).fit(df)
    wrong = trees.with_tree_prediction(other.transform(df), model, "again")
    assert wrong.filter(F.abs(F.col("again") - F.col("prediction")) > 1e-9).count() > 0
    assert trees.with_tree_prediction(model.transform(df.limit(0)), model, "again").collect() == []


def test_softmax(spark, rows):
    df = encoded(rows.withColumn("label", F.col("key") % 9 % 4))
    for family, data in (("multinomial", df), ("binomial", df.withColumn("label", F.col("label") % 2))):
        model = LogisticRegression(maxIter=15, family=family).fit(data)
        weights = linear.class_weights_table(data, model)
        scored = linear.with_softmax(model.transform(data), weights, "again")
        off = F.aggregate(F.zip_with("again", vector_to_array("probability"), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: F.greatest(a, b))
        assert scored.agg(F.max(off)).first()[0] < 1e-12
        assert scored.filter(linear.likeliest(F.col("again")) != F.col("prediction")).count() == 0
    large = spark.createDataFrame([(Vectors.dense([1000.0]),), (Vectors.sparse(1, {}),)], ["features"])
    two = spark.createDataFrame([(0, 0.0, [0.0]), (1, 0.0, [5.0])], "class int, intercept double, weights array<double>")
    assert [r["p"] for r in linear.with_softmax(large, two, "p").collect()] == [[0.0, 1.0], [0.5, 0.5]]


def test_entries_of_vectors(spark):
    vectors = [Vectors.dense([0.0, 2.0]), Vectors.sparse(9, {3: 1.5, 7: 0.0}), Vectors.dense([]), Vectors.sparse(4, {})]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], ["id", "v"])
    got = [[tuple(e) for e in r["e"]] for r in df.select("id", linear.filled_entries(F.col("v")).alias("e")).orderBy("id").collect()]
    assert got == [[(0, 0.0), (1, 2.0)], [(3, 1.5), (7, 0.0)], [], []]
    buckets = text.filled_buckets(df, "id", "v").collect()
    assert sorted(map(tuple, buckets)) == [(0, 1, 2.0), (1, 3, 1.5)]


def test_models_score_after_counts_on_the_way(spark, rows):
    """A session that has counted rows on their way to a write still scores with binary models."""
    from tallywright.operators.counting import StageCounts

    counts = StageCounts()
    counts.mark(rows, "all").write.format("noop").mode("overwrite").save()
    assert counts.counts() == {"all": 600}
    df = encoded(rows)
    for estimator in (RandomForestClassifier(numTrees=2, seed=1), models.logistic("label")):
        model = models.fit(estimator, df, ["features", "label"], ["key"])
        assert model.transform(df).filter("prediction is null").count() == 0


def posts(spark):
    words = ["good", "fine", "bad", "poor", "day", "night", "rain", "sun"]
    n = F.col("id")
    picked = [F.element_at(F.array(*map(F.lit, words)), (F.abs(F.hash(n, F.lit(i))) % 8 + 1).cast("int")) for i in range(6)]
    return spark.range(240).select(n.alias("key"), F.array(*picked).alias("words")).withColumn(
        "label", F.when(F.array_contains("words", "good"), 0.0).when(F.array_contains("words", "bad"), 1.0).otherwise(2.0)
    )


class Noted(Transformer):
    """Adds one to each number, and to ``seen`` for each row it makes."""

    def __init__(self, seen):
        super().__init__()
        self.seen = seen

    def _transform(self, df):
        seen = self.seen

        def more(x):
            seen.add(1)
            return x + 1.0

        return df.withColumn("y", F.udf(more, "double")("x"))


def test_grid_search_transforms_rows_once(spark):
    """Not for each fold, grid point, and score."""
    i = F.col("id")
    train = spark.range(300).select(i.alias("key"), (F.abs(F.hash("id")) % 50).cast("double").alias("x"), (i % 2).cast("double").alias("label"))
    assembler, regression = VectorAssembler(inputCols=["y"], outputCol="features"), LogisticRegression(labelCol="label", maxIter=3)
    points, seen = [{regression.regParam: r} for r in (0.01, 0.1)], spark.sparkContext.accumulator(0)
    found = tuning.grid_search(train, ["key"], [Noted(seen), assembler, regression], points, "label", tuning.weighted_f1)
    assert seen.value == 300 and found.predictions.count() == 600 and len(found.best.stages) == 3
    plain = tuning.grid_search(train.withColumn("y", F.col("x") + 1), ["key"], [assembler, regression], points, "label", tuning.weighted_f1)
    assert found.averages == plain.averages


def test_grid_search_keeps_no_words(spark, monkeypatch):
    """Neither the words nor counts that a later fit does not read are kept."""
    seen, keep = [], models.kept
    monkeypatch.setattr(models, "kept", lambda df: seen.append(df.columns) or keep(df))
    monkeypatch.setattr(tuning, "kept", models.kept)
    counts, regression = HashingTF(inputCol="words", outputCol="tf", numFeatures=16), models.logistic("label", 3)
    points = ParamGridBuilder().addGrid(counts.numFeatures, [8, 16]).addGrid(regression.regParam, [0.01, 0.1]).build()
    tuning.grid_search(posts(spark), ["key"], [counts, text.idf("tf", "features"), regression], points, "label", tuning.weighted_f1)
    assert sorted(map(sorted, seen)) == [["_fold", "features", "key", "label"]] * 6 + [["_fold", "key", "label", "tf"]] * 2


def test_partitions_follow_the_bytes_of_lists(spark, monkeypatch):
    """Few rows of many words lie in as many partitions as keep each small."""
    rows = posts(spark)
    n_bytes = sum(sum(8 + len(w) for w in r["words"]) for r in rows.collect())
    assert models.partitions_of(rows) == models.partitions_of(rows.limit(0)) == 16
    for per, partitions in ((n_bytes // 16 + 1, 16), (n_bytes // 17, 32), (n_bytes // 60, 64)):
        monkeypatch.setattr(models, "BYTES_PER_PARTITION", per)
        assert models.partitions_of(rows) == partitions and models.partitions_of(rows.select("key")) == 16
        with models.training_rows(rows, ["key"]) as placed:
            assert placed.rdd.getNumPartitions() == partitions


def test_grid_search_is_that_of_the_cross_validator(spark):
    """Same averages, and what grid points share is fitted once for each fold."""
    train = posts(spark)
    counts = HashingTF(inputCol="words", outputCol="tf", numFeatures=16)
    idf = text.idf("tf", "features")
    regression = models.logistic("label", 10)
    points = ParamGridBuilder().addGrid(counts.numFeatures, [8, 16]).addGrid(regression.regParam, [0.01, 0.1]).build()
    found = tuning.grid_search(train, ["key"], [counts, idf, regression], points, "label", tuning.weighted_f1)
    f1 = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    twin = tuning.cross_validate(train, ["key"], Pipeline(stages=[counts, idf, regression]), points, f1)
    assert found.averages == pytest.approx(twin.avgMetrics, abs=1e-12)
    assert found.prefix_fits == 6
    assert found.predictions.groupBy("point").count().collect() == [(p, 240) for p in [r["point"] for r in found.predictions.groupBy("point").count().collect()]]
    assert found.points[found.best_point] == points[int(np.argmax(twin.avgMetrics))]
    mine, theirs = (m.transform(train).orderBy("key").select("prediction").collect() for m in (found.best, twin.bestModel))
    assert mine == theirs
    assert {c for c in found.scores().columns} == {"numFeatures", "regParam", "avg_metric"}


def test_figures_of_a_fold():
    cells = {(0.0, 0.0): 3, (0.0, 1.0): 1, (1.0, 1.0): 2, (2.0, 1.0): 1}
    assert tuning.recall_of(0.0)(cells) == 0.75 and tuning.recall_of(9.0)(cells) == 0.0
    assert tuning.weighted_f1(cells) == pytest.approx((2 * 1 * 0.75 / 1.75) * 4 / 7 + (2 * 0.5 * 1 / 1.5) * 2 / 7)


def test_partitions_follow_the_rows():
    assert [models.partitions_for(n) for n in (0, 1, 16 << 20, (16 << 20) + 1, 100 << 20)] == [16, 16, 16, 32, 128]
    assert models.partitions_for(11 << 20, 10) == 16 and models.partitions_for(0, 10) == 10


def factors(spark, n, rank, seed, negative=False):
    values = np.random.default_rng(seed).gamma(0.7, 1.0, (n, rank)).astype(np.float32)
    values[n // 3] = 0
    values[n // 2] = values[n // 2 - 1]  # equal scores
    if negative:
        values -= 0.5
    return values, spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(values)], "id int, features array<float>")


def best_of(u, v, k):
    """By brute force, scores as floats, of equal ones the smaller item."""
    scores = (u.astype(np.float64) @ v.astype(np.float64).T).astype(np.float32)
    ids = np.arange(len(v)) * 3
    return {i * 3: [(int(ids[j]), float(row[j])) for j in np.lexsort((ids, -row))[:k]] for i, row in enumerate(scores)}


@pytest.mark.parametrize("negative", [False, True])
@pytest.mark.parametrize("k, block, size", [(3, 16, 1 << 26), (3, 7, 60 * 8 * 6), (500, 64, 1 << 26)])
def test_top_scores(spark, k, block, size, negative):
    """Exact for any size of blocks and rounds, ties and factors of length zero included."""
    (u, users), (v, items) = factors(spark, 200, 4, 1, negative), factors(spark, 300, 4, 2, negative)
    found = recommend.top_scores(users, items, k, block, size).collect()
    assert {r["id"]: [tuple(b) for b in r["best"]] for r in found} == best_of(u, v, k)
    if k == 3:
        assert sum(r["n_scored"] for r in found) < 0.9 * len(u) * len(v)


def test_top_scores_without_rows(spark):
    _, some = factors(spark, 10, 4, 1)
    assert recommend.top_scores(some.limit(0), some, 3).collect() == []
    assert [r["best"] for r in recommend.top_scores(some, some.limit(0), 3).collect()] == [[]] * 10


def test_top_items_are_those_of_the_model(spark):
    ratings = spark.range(900).select(
        F.concat(F.lit("u"), (F.col("id") % 40).cast("string")).alias("user_id"),
        (F.col("id") * 7 % 61).alias("product_id"),
        (F.abs(F.hash("id")) % 5 + 1).cast("double").alias("rating"),
    )
    model = recommend.fit_als(recommend.als(max_iter=3), ratings)
    mine = {(r["user_id"], i): x["rating"] for r in recommend.top_items(model, 5).collect() for i, x in enumerate(r["recommendations"])}
    named = {r["_user"]: r["user_id"] for r in model.users.collect()}
    theirs = {(named[r["_user"]], i): x["rating"] for r in model.model.recommendForAllUsers(5).collect() for i, x in enumerate(r["recommendations"])}
    assert mine.keys() == theirs.keys() and all(mine[k] == pytest.approx(theirs[k], rel=1e-6) for k in mine)
    some = recommend.top_items(model, 2, spark.createDataFrame([("u3",), ("nobody",)], "user_id string")).collect()
    assert [r["user_id"] for r in some] == ["u3"]
    scored = recommend.with_factors(model.transform(ratings), model)
    again = linear.dot(F.col("_user_factors"), F.col("_item_factors"))
    assert scored.count() == 900 and scored.filter(F.abs(again - F.col("prediction")) > 1e-5).count() == 0


def test_table_indexer_is_the_string_indexer(spark):
    """Same indices by tables, for seen, unseen and null values."""
    rows = spark.range(500).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("a"), (F.abs(F.hash("id")) % 23).cast("string"))).alias("a"),
        (F.col("id") % 7).cast("string").alias("b"),
    )
    train = rows.filter("a <> 'a3' and b <> '5'")
    mine = indexing.TableIndexer(["a", "b"], ["ai", "bi"], "key", "keep").fit(train).transform(rows)
    theirs = indexing.string_indexer(["a", "b"], ["ai", "bi"], "keep").fit(train).transform(rows)
    assert mine.columns == theirs.columns and sorted(mine.collect(), key=str) == sorted(theirs.collect(), key=str)
    with pytest.raises(Exception, match="has no index"):
        indexing.TableIndexer(["a"], ["ai"], "key").fit(train).transform(rows).collect()


def test_jobs_with_a_category_of_very_many_values(spark):
    """Same scores as with labels on the driver, and a column of which each row has its own."""
    from tallywright.plans import churn, fraud

    n = F.col("id")
    rows = spark.range(3000).select(
        n.alias("transaction_id"),
        F.lit("2024-01-05 10:00:00").alias("transaction_time"),
        (F.abs(F.hash(n)) % 900 + 10).cast("double").alias("transaction_amount"),
        (n % 60 + 18).cast("int").alias("customer_age"),
        F.concat(F.lit("m"), (n % 20).cast("string")).alias("merchant"),
        F.concat(F.lit("r"), n.cast("string")).alias("customer_region"),
        (F.abs(F.hash(n, F.lit(1))) % 10 < 3).cast("int").alias("is_fraud"),
    )
    few = ("merchant",)
    driver = fraud.fraud_logistic(rows, ["transaction_id"], few).predictions
    table = fraud.fraud_logistic(rows, ["transaction_id"], few, wide=few).predictions
    both = driver.select("transaction_id", "probability_1").join(table.select("transaction_id", F.col("probability_1").alias("again")), "transaction_id")
    assert both.count() == driver.count() == table.count()
    assert both.filter(F.abs(F.col("again") - F.col("probability_1")) > 1e-9).count() == 0
    forest = fraud.fraud_forest(rows, ["transaction_id"], trees=3, depth=3, wide=("customer_region",))
    assert forest.predictions.filter("prediction_best is null").count() == 0
    people = rows.select(F.col("transaction_id").alias("customer_id"), "merchant", "customer_region", "transaction_amount", F.when(F.col("is_fraud") == 1, "Y").otherwise("N").alias("churn"))
    scored = churn.churn_model(people, categorical=("merchant", "customer_region"), numeric=("transaction_amount",), wide=("customer_region",))
    assert scored.predictions.count() == 3000 and scored.predictions.filter("probability_1 is null").count() == 0


def test_forests_within_a_forest(spark, rows):
    """At its own size and depth it is the model; cut down, the plain walk over its nodes."""
    df = encoded(rows)
    model = RandomForestClassifier(labelCol="label", numTrees=6, maxDepth=5, seed=3).fit(df)
    whole = {r["key"]: (r["features"].toArray(), r["prediction"]) for r in model.transform(df).collect()}
    scored = trees.smaller_forests(df.select("key", "features", "flag"), model, [6, 2], [5, 1, 3])
    assert scored.columns == ["key", "flag", "trees", "depth", "prediction"]
    within = {(r["key"], r["trees"], r["depth"]): r["prediction"] for r in scored.collect()}
    assert len(within) == 600 * 6
    nodes = {}
    for r in trees.tree_nodes(df, model).collect():
        nodes.setdefault(r["tree"], {})[r["node"]] = r

    def plain(x, count, depth):
        votes = np.zeros(2)
        for tree in range(count):
            at = nodes[tree][0]
            for _ in range(depth):
                if at["left"] < 0:
                    break
                value = x[at["feature"]]
                left = value in at["values"] if at["categorical"] else value <= at["values"][0]
                at = nodes[tree][at["left"] if left else at["right"]]
            votes += np.array(at["votes"]) / sum(at["votes"])
        return float(votes.argmax())

    for key, (x, prediction) in whole.items():
        assert within[key, 6, 5] == prediction
        assert all(within[key, n, d] == plain(x, n, d) for n in (2, 6) for d in (1, 3, 5))
    assert trees.smaller_forests(df.limit(0).select("key", "features"), model, [2], [1]).collect() == []


def test_models_are_read_in_place(spark, rows):
    """Neither trees nor coefficients become a column that is copied to each row."""
    df = encoded(rows)
    forest = RandomForestClassifier(labelCol="label", numTrees=3, maxDepth=4, seed=3).fit(df)
    price = RandomForestRegressor(labelCol="price", numTrees=3, maxDepth=4, seed=3).fit(df)
    logistic = LogisticRegression(maxIter=3, family="multinomial").fit(df)
    for scored, name in (
        (trees.with_tree_probability(df, forest, "p"), "_trees"),
        (trees.with_tree_prediction(df, price, "p"), "_trees"),
        (linear.with_softmax(df, linear.class_weights_table(df, logistic), "p"), "_classes"),
    ):
        assert f"AS {name}" not in scored.select("key", "p")._jdf.queryExecution().executedPlan().toString()
        assert f"AS {name}" not in scored._jdf.queryExecution().executedPlan().toString()


def test_forest_search(spark, rows):
    """One fit for each fold; the largest point is what separate fits give, and the best one is refitted."""
    df = encoded(rows).select("key", "features", "label")
    forest = models.forest_classifier("label", seed=5)
    found = tuning.forest_search(df, ["key"], forest, (3, 6), (2, 4), "label", tuning.recall_of(1.0))
    apart = tuning.grid_search(df, ["key"], [forest], found.points, "label", tuning.recall_of(1.0))
    largest = found.points.index({forest.numTrees: 6, forest.maxDepth: 4})
    assert found.averages[largest] == pytest.approx(apart.averages[largest], abs=1e-12)
    assert all(abs(a - b) < 0.15 for a, b in zip(found.averages, apart.averages))
    best = found.points[found.best_point]
    assert found.best.stages[0].getNumTrees == best[forest.numTrees]
    assert sorted(r["count"] for r in found.predictions.groupBy("point", "fold").count().groupBy("point").agg(F.sum("count").alias("count")).collect()) == [600] * 4
    assert found.scores().columns == ["numTrees", "maxDepth", "avg_metric"] or set(found.scores().columns) == {"numTrees", "maxDepth", "avg_metric"}
