"""Views which give the business datasets over the given tables.

The tables hold no nulls and no broken dates, so the views put some in: by the
number of the order or event, as a fixed rule both engines can compute. No row
is left out by that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions.hashing import unit_hash
from tallywright.operators.lookup import attach_lookup
from tallywright.sources.readers import spread_small_scan
from tallywright.sources.scratch import materialize

# Fixed values of the transaction data: merchant and region names.
MERCHANTS = ("Grocery", "Fuel", "Electronics", "Travel", "Food", "Clothing")
REGIONS = ("North", "South", "East", "West")
CHURN_CUT = "2000-08-01"

SALES_COLUMNS = (
    "order_id",
    "customer_id",
    "order_date",
    "city",
    "category",
    "price",
    "qty",
    "discount_pct",
    "payment_method",
    "order_status",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_every(key: str, n: int, value: Column) -> Column:
    return F.when(F.col(key) % n != 0, value)


def _date_text(date: Column, key: str) -> Column:
    """The date in one of four notations; the last matches no sales format."""
    kind = F.col(key) % 20
    return (
        F.when(kind < 7, F.date_format(date, "dd-MM-yyyy"))
        .when(kind < 13, F.date_format(date, "M/d/yyyy"))
        .when(kind < 19, F.date_format(date, "MM/dd/yyyy"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their date as text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), _date_text(F.col("o_orderdate"), "o_orderkey").alias("order_date")
    )


def sales(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = SALES_COLUMNS,
    per_order: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Order lines as raw sales. Only the tables that ``columns`` need are joined.

    What belongs to an order is joined to the orders, and the parts to the lines
    while these are narrow, so that no wide line is shuffled but once, by order.
    ``per_order`` is a step on columns of the order alone; it runs once per order.
    The joins to parts and customers add columns to a row and no rows, so a best seller
    or a giant customer makes one side of a shuffled join skewed, which Spark divides
    at run time.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _date_text(F.col("o_orderdate"), "o_orderkey").alias("order_date"),
        _null_every("o_orderkey", 13, F.col("o_orderpriority")).alias("payment_method"),
        F.col("o_orderstatus").alias("order_status"),
    )
    if per_order is not None:
        orders = per_order(orders)
    if "city" in columns:
        nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        homes = (
            table(spark, sf_dir, "customer")
            .select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
            .join(nations, "c_nationkey", "left")
        )
        orders = orders.join(homes, "customer_id", "left")
        orders = orders.withColumn("city", _null_every("order_id", 11, F.col("n_name")))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_partkey",
        F.col("l_quantity").alias("qty"),
        _null_every("l_orderkey", 7, F.col("l_discount") * 100).alias("discount_pct"),
    )
    if {"price", "category"} & set(columns):
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_retailprice").alias("price"),
            F.col("p_type").alias("category"),
        )
        lines = lines.join(parts, "l_partkey", "left")
    return lines.join(orders, "order_id").select(*columns)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as card transactions, with missing merchants and amounts below zero."""
    merchant = F.get(F.array(*[F.lit(m) for m in MERCHANTS]), (F.col("event_id") * 7919 % 6).cast("int"))
    region = F.get(F.array(*[F.lit(r) for r in REGIONS]), (F.col("user_id") % 4).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_time"),
        (F.col("value") - 5).alias("transaction_amount"),
        _null_every("event_id", 17, merchant).alias("merchant"),
        (F.lit(18) + F.col("user_id") % 62).cast("int").alias("customer_age"),
        region.alias("customer_region"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a probability that needs no model."""
    label = F.col("is_fraud")
    p = F.lit(0.7) * unit_hash("transaction_id", purpose="score") + F.lit(0.3) * label
    return (
        transactions(spark, sf_dir)
        .select("transaction_id", "is_fraud", p.alias("probability_1"))
        .withColumn("prediction", (F.col("probability_1") >= 0.5).cast("double"))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the figures of their orders before the cut date, as text
    or number. Churned is who ordered nothing from that date on."""
    cut = F.lit(CHURN_CUT).cast("date")
    date = F.col("o_orderdate").cast("date")
    before = date < cut
    latest = F.struct("o_orderdate", "o_orderkey")
    figures = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            F.count_if(before).alias("order_count"),
            F.sum(F.when(before, F.col("o_totalprice").cast("decimal(18,2)"))).alias("total_spent"),
            F.max(F.when(before, F.col("o_totalprice"))).alias("largest_order"),
            F.datediff(cut, F.min(F.when(before, date))).alias("tenure_days"),
            F.max_by(F.when(before, F.col("o_orderstatus")), F.when(before, latest)).alias("last_status"),
            F.max_by(F.when(before, F.col("o_orderpriority")), F.when(before, latest)).alias("last_priority"),
            F.count_if(~before).alias("later_orders"),
        )
    )
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    people = (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.col("c_custkey").alias("customer_id"), "c_acctbal", "c_mktsegment", "n_name", "r_name")
    )
    balance = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    return people.join(figures, "customer_id", "left").select(
        "customer_id",
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        "last_status",
        "last_priority",
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("overdrawn"),
        F.when(F.col("order_count") > 5, "Y").otherwise("N").alias("regular"),
        F.col("order_count").cast("string").alias("order_count"),
        F.col("tenure_days").cast("string").alias("tenure_days"),
        F.col("total_spent").cast("double").alias("total_spent"),
        (F.col("total_spent").cast("double") / F.col("order_count")).alias("mean_order"),
        "largest_order",
        F.when(F.col("customer_id") % 13 == 0, "n/a").otherwise(balance).alias("balance"),
        F.when(F.col("later_orders") > 0, "N").otherwise("Y").alias("churn"),
    )


CHURN_CATEGORICAL = ("segment", "nation", "region", "last_status", "last_priority", "overdrawn", "regular")
CHURN_NUMERIC = ("order_count", "tenure_days", "total_spent", "mean_order", "largest_order", "balance")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean rating from 1 to 5 of each product a user ordered."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    points = F.lit(1) + F.col("l_quantity").cast("int") % 5
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id"))
        .agg(F.sum(points).alias("points"), F.count(F.lit(1)).alias("n_lines"))
        .withColumn("rating", F.col("points") / F.col("n_lines"))
    )


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings predicted by the mean of their product: a score without a model.

    The ratings are stored, as both sides of the join come from them. A product
    with very many ratings is divided by the lookup.
    """
    rows = materialize(ratings(spark, sf_dir), "ratings")
    means = rows.groupBy("product_id").agg(
        (F.sum("points") / F.sum("n_lines")).alias("prediction"), F.count(F.lit(1)).alias("n_ratings")
    )
    joined = attach_lookup(rows, materialize(means, "means"), "product_id", "n_ratings", "user_id")
    return joined.select("user_id", "product_id", "rating", "prediction")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as patients with five measurements and a 0/1 disease."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("patient_id"),
        (F.col("l_linenumber") * 10).alias("age"),
        F.col("l_quantity").alias("bmi"),
        (F.col("l_tax") * 100).alias("blood_pressure"),
        (F.col("l_discount") * 100).alias("glucose_level"),
        F.col("l_extendedprice").alias("cholesterol"),
        (F.col("l_returnflag") == "R").cast("int").alias("disease"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as posts with one of three sentiments."""
    sentiment = (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    )
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(F.col("doc_id").alias("post_id"), F.col("text").alias("post_text"), sentiment.alias("sentiment"))
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as posts without a sentiment."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"), F.col("text").alias("post_text")
    )
    return spread_small_scan(documents)
