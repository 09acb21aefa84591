"""The jobs on small inline rows with known answers."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallywright.functions.numbers import logistic_probability
from tallywright.operators import recommend
from tallywright.plans import churn, disease, fraud, recommendations, sales, sentiment
from tallywright.sources import readers

RAW_SALES = [
    (1001, "1/5/2024", "Chennai", 2, 55000),
    (1002, "1/6/2024", "Salem", None, 800),
    (1003, "2024-01-07", "Salem", 1, 500),
    (1004, "07-01-2024", "Madurai", 1, 0),
    (1005, "soon", "Madurai", 1, 90),
]


def test_raw_sales_are_cleaned(spark, tmp_path):
    df = spark.createDataFrame(RAW_SALES, "order_id int, order_date string, city string, quantity int, price int")
    clean = sales.clean_raw_sales(df, output=str(tmp_path / "clean"))
    assert sorted((r["order_id"], str(r["order_date"])) for r in clean.collect()) == [
        (1001, "2024-01-05"),
        (1003, "2024-01-07"),
        (1005, "None"),
    ]
    assert readers.read_parquet(spark, str(tmp_path / "clean")).count() == 3
    assert sales.clean_raw_sales(df, require_parsed=True).count() == 2


def sales_rows(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("order_id"),
        (i % 90).alias("customer_id"),
        F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (i % 300).cast("int")), "dd-MM-yyyy").alias("order_date"),
        F.when(i % 5 == 0, None).otherwise(F.concat(F.lit("city"), (i % 3).cast("string"))).alias("city"),
        F.concat(F.lit("cat"), (i % 4).cast("string")).alias("category"),
        (F.lit(10) + i % 3 * 100).cast("double").alias("price"),
        (i % 7).cast("double").alias("qty"),
        F.lit(None).cast("double").alias("discount_pct"),
        F.when(i % 2 == 0, "card").alias("payment_method"),
        F.when(i % 4 == 0, "open").otherwise("done").alias("order_status"),
    )


def test_sales_report(spark, tmp_path):
    clean = sales.clean_sales(sales_rows(spark)).persist()
    assert clean.filter("qty <= 0 or city is null or discount_pct is null or payment_method is null").count() == 0
    report = sales.sales_report(clean, str(tmp_path))
    total = clean.agg(F.sum("revenue")).first()[0]
    assert report.monthly_revenue.agg(F.sum("monthly_revenue")).first()[0] == total
    assert report.top_cities.count() == 4 and report.top_category.count() == 1
    assert report.repeat_rate.first()["total_customers"] == 90
    assert readers.read_csv(spark, str(tmp_path / "top_cities")).count() == 4
    assert readers.read_csv(spark, str(tmp_path / "monthly_revenue")).columns == ["year", "month", "monthly_revenue"]


def test_price_model_learns_the_city(spark):
    """The price depends on id % 3, as does the city where it is known."""
    clean = sales.clean_sales(sales_rows(spark))
    result = sales.price_model(clean, ["order_id"], trees=10, depth=4)
    spread = clean.agg(F.stddev("price")).first()[0]
    assert result.metrics.first()["rmse"] < spread * 0.8


def test_price_model_stores_the_parts(spark, monkeypatch):
    """Neither the fit nor its checks hash the keys again."""
    clean, seen, fit = sales.clean_sales(sales_rows(spark)), [], sales.models.fit
    monkeypatch.setattr(sales.models, "fit", lambda pipeline, train, *rest: seen.append(train) or fit(pipeline, train, *rest))
    found = sales.price_model(clean, ["order_id"], trees=1, depth=1)
    train, test = sales.split.hash_split(clean, ["order_id"], (0.8, 0.2), 42)
    assert "md5" not in seen[0]._jdf.queryExecution().toString() and "_part" not in found.predictions.columns
    assert seen[0].count() == train.count() and found.predictions.count() == test.count()


def test_price_model_guards(spark):
    clean = sales.clean_sales(sales_rows(spark))
    one_city = clean.withColumn("city", F.lit("x"))
    for rows in (one_city, clean.limit(0)):
        result = sales.price_model(rows, ["order_id"])
        assert result.model is None and result.predictions.count() == 0
        assert "prediction" in result.predictions.columns


def card_rows(spark, n=3000, region=True):
    """Fraud is what costs more than 400; one row in ten."""
    i = F.col("id")
    df = spark.range(n).select(
        i.alias("transaction_id"),
        F.when(i % 2 == 0, "2024-01-02 03:04:05").otherwise("02-01-2024 03:04").alias("transaction_time"),
        (i * 37 % 450 + F.when(i % 50 == 0, -500).otherwise(1)).cast("double").alias("transaction_amount"),
        (F.lit(20) + i % 50).cast("int").alias("customer_age"),
        F.when(i % 9 == 0, None).otherwise(F.concat(F.lit("m"), (i % 6).cast("string"))).alias("merchant"),
        F.concat(F.lit("r"), (i % 4).cast("string")).alias("customer_region"),
        (i * 37 % 450 > 400).cast("int").alias("is_fraud"),
    )
    return df if region else df.drop("customer_region")


@pytest.mark.parametrize("balance_first", [False, True])
def test_fraud_logistic_beats_the_majority(spark, balance_first):
    result = fraud.fraud_logistic(card_rows(spark), ["transaction_id"], balance_first=balance_first)
    recall = {r["is_fraud"]: 0 for r in result.confusion.collect()}
    for row in result.confusion.collect():
        if row["is_fraud"] == row["prediction"]:
            recall[row["is_fraud"]] += row["n_rows"]
    assert recall[1] > 0 and result.report.first()["accuracy"] > 0.8
    ids = result.predictions.groupBy("transaction_id").count().filter("count > 1").count()
    assert (ids > 0) == balance_first


def test_fitted_coefficients_give_the_probability(spark):
    result = fraud.fraud_logistic(card_rows(spark), ["transaction_id"])
    fitted = result.model.stages[-1]
    columns = ["transaction_amount", "customer_age", "merchant_index", "customer_region_index"]
    p = logistic_probability(columns, list(fitted.coefficients), fitted.intercept)
    worst = result.predictions.agg(F.max(F.abs(p - F.col("probability_1")))).first()[0]
    assert worst < 1e-9


def test_threshold_is_exclusive(spark):
    result = fraud.fraud_logistic(card_rows(spark), ["transaction_id"], threshold=0.4)
    wrong = result.predictions.filter((F.col("probability_1") > 0.4) != (F.col("prediction") == 1.0))
    assert wrong.count() == 0


@pytest.mark.parametrize(
    ("balancing", "threshold_on", "region"),
    [("weights", "validation", True), ("oversample", "test", True), ("both", "test", False)],
)
def test_fraud_forest(spark, tmp_path, balancing, threshold_on, region):
    result = fraud.fraud_forest(
        card_rows(spark, region=region),
        ["transaction_id"],
        trees=10,
        depth=4,
        balancing=balancing,
        threshold_on=threshold_on,
        output=str(tmp_path / "out"),
    )
    best = result.best.first()
    assert result.report.first()["f1"] > 0.95 and result.recall.first()["recall"] > 0.9
    assert best["f1"] == max(r["f1"] for r in result.sweep.collect())
    stored = readers.read_parquet(spark, str(tmp_path / "out"))
    assert stored.filter(
        (F.col("probability_1") >= best["threshold"]) != (F.col("prediction_best") == 1.0)
    ).count() == 0


def test_fraud_forest_checks_its_options(spark):
    with pytest.raises(ValueError):
        fraud.fraud_forest(card_rows(spark), ["transaction_id"], balancing="none")


def customer_rows(spark, n=600):
    i = F.col("id")
    columns = {"customer_id": i, "churn": F.when(i % 40 > 25, "Y").otherwise("N")}
    for k, name in enumerate(churn.CATEGORICAL):
        columns[name] = F.concat(F.lit(name), (i % (k + 1)).cast("string"))
    for name in churn.NUMERIC:
        columns[name] = (i % 40).cast("string")
    columns["complaints"] = F.when(i == 7, "many").otherwise((i % 40).cast("string"))
    return spark.range(n).select(*[c.alias(name) for name, c in columns.items()])


@pytest.mark.parametrize("evaluate_on", ["test", "train"])
def test_churn(spark, tmp_path, evaluate_on):
    result = churn.churn_model(customer_rows(spark), evaluate_on=evaluate_on, output=str(tmp_path / "o"))
    assert result.predictions.count() == 599  # one customer has no number of complaints
    evaluated = sum(r["n_rows"] for r in result.confusion.collect())
    assert evaluated == 599 if evaluate_on == "train" else 120 < evaluated < 240
    assert result.report.first()["accuracy"] > 0.9
    assert readers.read_parquet(spark, str(tmp_path / "o")).count() == 599


def rating_rows(spark):
    """Users like every other product, by their own number being even or odd."""
    users = spark.range(40).select(F.col("id").cast("int").alias("user_id"))
    products = F.explode(F.sequence(F.lit(0), F.lit(19))).alias("product_id")
    liked = (F.col("user_id") + F.col("product_id")) % 2 == 0
    return users.select("user_id", products).withColumn("rating", F.when(liked, 5).otherwise(1))


def test_recommendations(spark, tmp_path):
    result = recommendations.recommendations(rating_rows(spark), output=str(tmp_path / "o"))
    assert result.metrics.first()["rmse"] < 1.0
    assert result.comparison.columns == ["Actual_Rating", "Predicted_Rating", "Count"]
    top = recommend.flat_recommendations(result.top)
    assert top.count() == 120
    assert top.filter((F.col("user_id") + F.col("product_id")) % 2 == 1).count() == 0
    assert readers.read_csv(spark, str(tmp_path / "o")).count() == result.predictions.count()


def test_cold_rows_are_dropped(spark):
    model = recommend.fit_als(recommend.als(rank=2, max_iter=2), rating_rows(spark))
    new = spark.createDataFrame([(999, 1, 5), (1, 1, 5), (1, 999, 5)], "user_id int, product_id int, rating int")
    assert [r["user_id"] for r in model.transform(new).collect()] == [1]


def test_ids_of_any_size_and_chosen_users(spark):
    """Ids beyond 2**31, and text, give what small numbers give."""
    small = rating_rows(spark)
    large = small.select((F.col("user_id") + 2**40).alias("user_id"), F.concat(F.lit("p"), "product_id").alias("product_id"), "rating")
    model = recommend.fit_als(recommend.als(), large)
    chosen = spark.createDataFrame([(2**40 + 3,), (2**40 + 4,), (5,)], "user_id long")
    top = recommend.flat_recommendations(recommend.top_items(model, 3, chosen)).collect()
    assert {r["user_id"] for r in top} == {2**40 + 3, 2**40 + 4} and len(top) == 6
    assert all((int(r["product_id"][1:]) + r["user_id"]) % 2 == 0 for r in top)
    assert recommend.top_items(model, 1).count() == 40
    assert model.transform(large).count() == 800


def test_fits_do_not_depend_on_the_layout(spark):
    """Forests and factors from one, four and seven partitions are the same."""
    cards, ratings = card_rows(spark), rating_rows(spark)

    def scores(n):
        forest = fraud.fraud_forest(cards.repartition(n), ["transaction_id"], trees=5, depth=4).predictions
        factors = recommend.fit_als(recommend.als(rank=2, max_iter=3), ratings.repartition(n))
        rows = [(r[0], r[1]) for r in forest.select("transaction_id", "probability_1").orderBy("transaction_id").collect()]
        return rows, [round(r[0], 4) for r in factors.transform(ratings).orderBy("user_id", "product_id").select("prediction").collect()]

    assert scores(1) == scores(4) == scores(7)


def test_complete_rows(spark):
    needed, every = (fraud.prepared(card_rows(spark), complete=c) for c in ("needed", "all"))
    assert needed.count() > every.count() > 0
    assert every.filter("merchant = 'unknown'").count() == 0 and needed.filter("merchant = 'unknown'").count() > 0
    with pytest.raises(ValueError):
        fraud.prepared(card_rows(spark), complete="some")


def test_rounded_errors(spark):
    raw = recommendations.recommendations(rating_rows(spark), rank=2, max_iter=2).metrics.first()
    rounded = recommendations.recommendations(rating_rows(spark), rank=2, max_iter=2, rounded=True).metrics.first()
    assert math.isclose(raw["rmse"], rounded["rmse"], abs_tol=0.01)


def patient_rows(spark):
    i = F.col("id")
    return spark.range(400).select(
        i.alias("patient_id"),
        (F.lit(20) + i % 60).alias("age"),
        (F.lit(18) + i % 20).cast("double").alias("bmi"),
        (F.lit(100) + i % 50).alias("blood_pressure"),
        (F.lit(80) + i % 100).alias("glucose_level"),
        (F.lit(150) + i % 90).alias("cholesterol"),
        (i % 100 > 80).cast("int").alias("disease"),
    )


def test_disease(spark, tmp_path):
    result = disease.disease_model(
        patient_rows(spark), trees=(3, 5), depths=(2, 4), output=str(tmp_path / "o")
    )
    assert result.grid.count() == 4
    per_class = {r["class"]: r for r in result.per_class.collect()}
    assert per_class[1.0]["recall"] > 0.9
    assert readers.read_parquet(spark, str(tmp_path / "o")).count() == result.scored.predictions.count()


POSTS = {"positive": "love this\n\"great\" phone", "negative": "never buy this awful phone again", "neutral": "it arrived today"}


def post_rows(spark):
    rows = []
    for i in range(150):
        mood = ("positive", "negative", "positive", "negative", "neutral")[i % 5]
        rows.append((i, f"{POSTS[mood]}, {i}", mood))
    rows.append((900, "no mood", None))
    return spark.createDataFrame(rows, "post_id int, post_text string, sentiment string")


@pytest.mark.parametrize("tune", [False, True])
def test_sentiment(spark, tmp_path, tune):
    result = sentiment.sentiment_model(
        post_rows(spark), buckets=(50, 100), regs=(0.01, 0.1), tune=tune, output=str(tmp_path / "o")
    )
    assert result.scored.report.first()["accuracy"] > 0.9
    assert (result.grid is None) != tune
    if tune:
        assert result.grid.count() == 4
    out = readers.read_csv(spark, str(tmp_path / "o"), multi_line=True)
    assert {(r["post_id"], r["post_text"]) for r in out.collect()} == {(r["post_id"], r["post_text"]) for r in result.scored.predictions.collect()}
    assert out.columns == ["post_id", "post_text", "sentiment", "predicted_label"]
    assert out.filter("sentiment = predicted_label").count() > 0.9 * out.count()
