"""The queries by name; each reads the given tables as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.functions import dates, numbers
from tallywright.operators import (
    aggregates,
    balance,
    cleaning,
    features,
    indexing,
    linear,
    metrics,
    models,
    recommend,
    split,
    text,
    thresholds,
    trees,
    tuning,
)
from tallywright.operators.counting import StageCounts
from tallywright.plans import churn, disease, fraud, recommendations, results, sales, sentiment, tables
from tallywright.sources.readers import read_csv, read_parquet
from tallywright.sources.scratch import materialize, scratch_path
from tallywright.sources.writers import write_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _clean(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Cleaned sales of the named columns and those cleaning itself needs. Dates
    are repaired on the orders, before these meet their lines."""
    needed = ("order_date", "price", "qty")
    wanted = [*needed, *[c for c in columns if c not in needed]]
    rows = tables.sales(spark, sf, wanted, lambda orders: cleaning.repair_dates(orders, "order_date"))
    return sales.clean_sales(rows)


# Sources and sinks


@_query
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.table(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = scratch_path(spark, "csv-scan")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


@_query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with nulls and quoted text through a CSV file."""
    rows = tables.table(spark, sf, "customer").withColumn(
        "c_name", F.concat(F.lit('"a, b" '), F.col("c_name"))
    ).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")))
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@_query
def csv_roundtrip_text(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, most of them of several lines, through CSV files."""
    rows = tables.table(spark, sf, "documents")
    path = scratch_path(spark, "csv-roundtrip-text")
    write_csv(rows, path, max_records=10_000)
    return read_csv(spark, path, rows.schema, multi_line=True)


@_query
def path_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Two folders of one file system by a full address and a pattern, as of an object store."""
    root = scratch_path(spark, "path-scan")
    address = root if "://" in root else f"file://{root}"
    orders = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_csv(orders.filter("o_orderkey % 2 = 0"), f"{address}/part-even")
    write_csv(orders.filter("o_orderkey % 2 <> 0"), f"{address}/part-odd")
    return read_csv(spark, f"{address}/part-*", orders.schema)


@_query
def replaced_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A folder that is replaced by what is read from it, and outlives a write that fails."""
    path = scratch_path(spark, "replaced-rows")
    orders = tables.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    write_parquet(orders, path)
    write_parquet(read_parquet(spark, path).filter("o_orderkey % 3 = 0"), path)
    last = orders.agg(F.max("o_orderkey")).scalar()
    broken = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("this row cannot be written"))).otherwise(F.col("o_orderkey"))
    try:
        write_parquet(orders.withColumn("o_orderkey", broken.cast("bigint")), path)
    except Exception as error:  # noqa: BLE001 - any failure of the write will do, but none may be missing
        return read_parquet(spark, path).withColumn("kept", F.lit(bool(str(error))))
    raise AssertionError("the write should have failed")


@_query
def single_file(spark: SparkSession, sf: str) -> DataFrame:
    """Files and rows of a small report that is written as one file."""
    report = balance.class_counts(tables.table(spark, sf, "orders"), "o_orderpriority")
    path = scratch_path(spark, "single-file")
    write_csv(report, path, single_file=True)
    back = read_csv(spark, path, report.schema).withColumn("file", F.input_file_name())
    return back.agg(F.countDistinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


@_query
def kept_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by status and in all, from rows that are kept while both read them."""
    orders = tables.table(spark, sf, "orders").select("o_orderstatus")
    with models.kept(orders) as rows:
        total = rows.count()
        counts = balance.class_counts(rows, "o_orderstatus").withColumn("n_all", F.lit(total).cast("bigint"))
        return materialize(counts, "kept-rows")


@_query
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    path = scratch_path(spark, "parquet-roundtrip")
    write_parquet(rows, path)
    return read_parquet(spark, path)


@_query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return cleaning.preview(rows, ["o_orderkey"], 5)


@_query
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.transactions(spark, sf)
    complete = F.col("merchant").isNotNull()
    positive = complete & (F.col("transaction_amount") > 0)
    return cleaning.stage_counts(
        rows,
        {
            "loaded": F.lit(True),
            "complete": complete,
            "positive": positive,
            "fraud": positive & (F.col("is_fraud") == 1),
            "genuine": positive & (F.col("is_fraud") == 0),
        },
    )


@_query
def observed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of the stages, from the write of the clean rows alone."""
    counts = StageCounts()
    clean = fraud.clean_transactions(tables.transactions(spark, sf), ["merchant"], counts)
    write_parquet(clean, scratch_path(spark, "observed"))
    return counts.frame(spark)


@_query
def empty_input(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the price job stops: on all sales, on none, and on those of one city."""
    clean = materialize(_clean(spark, sf, *tables.SALES_COLUMNS), "clean")
    first = clean.agg(F.min("city")).scalar()
    cases = {"all": clean, "none": clean.filter("price < 0"), "one city": clean.filter(F.col("city") == first)}
    rows = []
    for name, df in cases.items():
        result = sales.price_model(df, ["order_id"], trees=1, depth=1)
        rows.append((name, result.model is None, result.predictions.isEmpty(), result.metrics.first()["n_rows"] == 0))
    return spark.createDataFrame(rows, "case string, no_model boolean, no_rows boolean, no_errors boolean")


# Columns


@_query
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@_query
def drop_rename(spark: SparkSession, sf: str) -> DataFrame:
    return (
        tables.scored(spark, sf)
        .withColumn("prediction_best", numbers.as_flag(F.col("probability_1") >= 0.4))
        .drop("prediction")
        .withColumnRenamed("prediction_best", "prediction")
    )


@_query
def cast_numeric(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.customers(spark, sf)
    return cleaning.cast_numeric(rows, ["balance", "order_count"]).select("customer_id", "balance", "order_count")


@_query
def revenue(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.sales(spark, sf, ["order_id", "price", "qty"])
    return cleaning.add_product(rows, "price", "qty", "revenue")


@_query
def binary_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.customers(spark, sf).select("customer_id", "churn")
    return cleaning.label_from_text(rows, "churn", "churn_label")


@_query
def optional_column(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.transactions(spark, sf).select("transaction_id", "transaction_amount", "customer_age")
    present = cleaning.with_column_or(rows, "customer_age", "age_index", 0.0)
    return cleaning.with_column_or(present, "merchant_category", "merchant_index", 0.0)


@_query
def probability_of_class(spark: SparkSession, sf: str) -> DataFrame:
    """The second entry of each row's probability vector."""
    p = F.col("probability_1")
    rows = tables.scored(spark, sf).withColumn("probability", array_to_vector(F.array(1 - p, p)))
    return rows.select("transaction_id", numbers.class_probability("probability").alias("p"))


@_query
def rounded_prediction(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.with_rounded(tables.rated(spark, sf), "prediction", "rounded")
    return rows.select("user_id", "product_id", "rounded")


# Filters and nulls


@_query
def drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["order_id", "qty", "city", "payment_method", "discount_pct"]
    return cleaning.drop_nulls(tables.sales(spark, sf, columns), ["city", "payment_method", "discount_pct"])


@_query
def fill_nulls(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["order_id", "qty", "city", "payment_method", "discount_pct"]
    return cleaning.fill_nulls(
        tables.sales(spark, sf, columns), {"city": "Unknown", "payment_method": "Unknown", "discount_pct": 0}
    )


@_query
def positive_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.transactions(spark, sf).select("transaction_id", "transaction_amount")
    return cleaning.keep_positive(rows, "transaction_amount")


@_query
def conjunctive_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") - 10).alias("qty"),
        (F.col("l_discount") - 0.02).alias("price"),
    )
    return cleaning.keep_positive(rows, "price", "qty")


@_query
def repeat_customers(spark: SparkSession, sf: str) -> DataFrame:
    per_customer = aggregates.distinct_per_group(
        _clean(spark, sf, "customer_id", "order_id"), "customer_id", "order_id", "order_count"
    )
    return aggregates.more_than(per_customer, "order_count", 1)


@_query
def class_split(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per class after the equality split."""
    fraud_rows, genuine = balance.split_by_class(tables.transactions(spark, sf), "is_fraud")
    return fraud_rows.withColumn("side", F.lit("fraud")).unionByName(
        genuine.withColumn("side", F.lit("genuine"))
    ).select("transaction_id", "side")


@_query
def fraud_rows_needed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the fraud jobs where only the label and the numbers must be there."""
    return fraud.prepared(tables.transactions(spark, sf)).select("transaction_id", "merchant")


@_query
def fraud_rows_all(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the fraud jobs where no column may be null."""
    return fraud.prepared(tables.transactions(spark, sf), complete="all").select("transaction_id", "merchant")


# Dates


@_query
def parse_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.order_dates(spark, sf)
    return rows.withColumn("order_date", dates.parse_date(F.col("order_date"), "yyyy-MM-dd"))


@_query
def repair_dates(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.repair_dates(tables.order_dates(spark, sf), "order_date", require_parsed=True)


@_query
def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.transactions(spark, sf).select("transaction_id", "transaction_time")
    parsed = cleaning.parse_timestamps(rows, "transaction_time")
    return parsed.withColumn("transaction_time", F.col("transaction_time").cast("timestamp_ntz"))


@_query
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.repair_dates(tables.order_dates(spark, sf), "order_date")
    return cleaning.add_date_parts(rows, "order_date")


# Aggregates


@_query
def top_cities(spark: SparkSession, sf: str) -> DataFrame:
    top = aggregates.top_groups(_clean(spark, sf, "city"), "city", "revenue", "total_revenue", 5)
    return top.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@_query
def top_category(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.top_groups(_clean(spark, sf, "category"), "category", "qty", "total_quantity", 1)


@_query
def orders_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    clean = _clean(spark, sf, "customer_id", "order_id")
    return aggregates.distinct_per_group(clean, "customer_id", "order_id", "order_count")


@_query
def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    months = aggregates.monthly_totals(_clean(spark, sf), "order_date", "revenue", "monthly_revenue")
    return months.withColumn("monthly_revenue", F.col("monthly_revenue").cast("double"))


@_query
def repeat_customer_rate(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.repeat_rate(_clean(spark, sf, "customer_id", "order_id"), "customer_id", "order_id")


@_query
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return balance.class_counts(tables.patients(spark, sf), "disease")


@_query
def distinct_guard(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_guard(_clean(spark, sf, *sales.CATEGORICAL), sales.CATEGORICAL)


@_query
def sales_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning job on raw lines: complete, dated, and a positive price."""
    raw = tables.sales(spark, sf, ["order_id", "order_date", "payment_method", "price", "qty"])
    return sales.clean_raw_sales(raw)


@_query
def sales_prepared(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned rows that all sales reports start from."""
    rows = _clean(spark, sf, *tables.SALES_COLUMNS)
    return rows.withColumn("revenue", F.col("revenue").cast("double"))


# Unions, balance and splits


@_query
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    """All genuine rows and twice the fraud rows: duplicates stay."""
    rows = tables.transactions(spark, sf).select("transaction_id", "is_fraud")
    fraud_rows, genuine = balance.split_by_class(rows, "is_fraud")
    return genuine.unionByName(fraud_rows).unionByName(fraud_rows)


@_query
def oversample_minority(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.transactions(spark, sf).select("transaction_id", "is_fraud")
    return balance.oversample_minority(rows, "is_fraud", ["transaction_id"], copy_column="copy")


@_query
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "orders").select("o_orderkey")
    train, test = split.hash_split(rows, ["o_orderkey"], (0.8, 0.2))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@_query
def train_oversample(spark: SparkSession, sf: str) -> DataFrame:
    """The training part of a split, balanced."""
    rows = tables.transactions(spark, sf).select("transaction_id", "is_fraud")
    train, _ = split.hash_split(rows, ["transaction_id"], (0.8, 0.2))
    return balance.oversample_minority(train, "is_fraud", ["transaction_id"], copy_column="copy")


@_query
def fold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in each of three folds of the training part of a split."""
    train, _ = split.hash_split(tables.patients(spark, sf).select("patient_id"), ["patient_id"], (0.8, 0.2))
    return balance.class_counts(tuning.with_folds(train, ["patient_id"], output="fold"), "fold")


@_query
def split_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The part number of each order in a three-way split."""
    rows = tables.table(spark, sf, "orders").select("o_orderkey")
    return split.with_part(rows, ["o_orderkey"], "part", (0.64, 0.16, 0.2))


@_query
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return balance.class_weights(tables.patients(spark, sf), "disease")


@_query
def train_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.transactions(spark, sf).select("transaction_id", "is_fraud")
    train, _ = split.hash_split(rows, ["transaction_id"], (0.8, 0.2))
    return balance.with_binary_weights(train, "is_fraud", "class_weight_col")


# Features


@_query
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    mapping = indexing.category_index(rows, "o_custkey", "customer_index")
    return indexing.apply_category_index(rows, mapping, "o_custkey", "customer_index", "o_orderkey")


@_query
def string_index_keep(spark: SparkSession, sf: str) -> DataFrame:
    """Index fitted on the training orders; nulls get the number of labels."""
    priority = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority"))
    rows = tables.table(spark, sf, "orders").select("o_orderkey", priority.alias("payment_method"))
    train, _ = split.hash_split(rows, ["o_orderkey"])
    model = indexing.string_indexer(["payment_method"], ["payment_index"], "keep").fit(train)
    return model.transform(rows)


@_query
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Length, place of the one, and sum of each order's one-hot vector."""
    priority = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority"))
    rows = tables.table(spark, sf, "orders").select("o_orderkey", priority.alias("payment_method"))
    _, indexed = indexing.index_columns(rows, ["payment_method"], handle_invalid="keep")
    _, encoded = indexing.one_hot(indexed, ["payment_method_index"], ["vector"])
    slots = encoded.select("o_orderkey", numbers.vector_to_array("vector").alias("v"))
    return slots.select(
        "o_orderkey",
        F.size("v").alias("n_slots"),
        (F.array_position("v", F.lit(1.0)) - 1).alias("hot_slot"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@_query
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.assemble(tables.patients(spark, sf), disease.FEATURES)
    values = numbers.vector_to_array("features")
    return rows.select("patient_id", *[values[i].alias(f"f{i}") for i in range(len(disease.FEATURES))])


@_query
def assemble_keep(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of columns with nulls: a null is NaN there, and the row stays."""
    discount = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_discount"))
    lines = tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", discount.alias("d"))
    values = numbers.vector_to_array("features")
    rows = features.assemble(lines, ["l_quantity", "d"], handle_invalid="keep")
    return rows.select("l_orderkey", "l_linenumber", values[0].alias("f0"), F.isnan(values[1]).alias("missing"))


@_query
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    rows = text.with_words(tables.texts(spark, sf), "post_text", "words")
    return rows.select("post_id", F.size("words").alias("n_words"), F.concat_ws(" ", "words").alias("words"))


@_query
def remove_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    rows = text.with_filtered_words(tables.texts(spark, sf), "post_text", "words")
    return rows.select("post_id", F.size("words").alias("n_words"), F.concat_ws(" ", "words").alias("words"))


@_query
def hashing_tf(spark: SparkSession, sf: str) -> DataFrame:
    """The filled buckets of each document's hashed term counts."""
    words = text.ml_words(tables.texts(spark, sf), "post_text", "words")
    counted = text.hashing_tf("words", "counts").transform(words)
    return text.filled_buckets(counted, "post_id", "counts")


@_query
def term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    words = text.with_filtered_words(tables.texts(spark, sf), "post_text", "words")
    return text.term_frequency(words, "post_id", "words")


@_query
def idf_weights(spark: SparkSession, sf: str) -> DataFrame:
    words = text.with_filtered_words(tables.texts(spark, sf), "post_text", "words")
    return _rounded(text.idf_weights(words, "words"), "idf")


@_query
def tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    words = text.with_filtered_words(tables.texts(spark, sf), "post_text", "words")
    return _rounded(text.tf_idf(words, "post_id", "words"), "idf", "tf_idf")


@_query
def index_to_string(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of order lines by number; numbers past the list are unknown."""
    number = (F.col("o_orderkey") % 5).cast("double")
    rows = tables.table(spark, sf, "orders").select("o_orderkey", number.alias("prediction"))
    return indexing.index_to_label(rows, "prediction", ["positive", "negative", "neutral"], "predicted_label")


# Evaluation


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Irrational figures to 9 digits, beyond which two engines may differ."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


@_query
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(tables.scored(spark, sf), "is_fraud", "prediction")


@_query
def rating_comparison(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.with_rounded(tables.rated(spark, sf), "prediction", "rounded")
    return metrics.confusion_matrix(rows, "rating", "rounded", ("Actual_Rating", "Predicted_Rating"), "Count")


@_query
def positive_recall(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.positive_recall(tables.scored(spark, sf), "is_fraud", "prediction")


@_query
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.classification_report(tables.scored(spark, sf), "is_fraud", "prediction")
    return _rounded(report, *report.columns)


@_query
def per_class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    per_class = metrics.per_class_metrics(tables.scored(spark, sf), "is_fraud", "prediction")
    return _rounded(per_class, "precision", "recall", "f1")


@_query
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(thresholds.threshold_sweep(tables.scored(spark, sf), "is_fraud", "probability_1"), "f1")


@_query
def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    sweep = thresholds.threshold_sweep(tables.scored(spark, sf), "is_fraud", "probability_1")
    return _rounded(thresholds.best_threshold(sweep), "f1")


@_query
def apply_threshold(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.scored(spark, sf)
    best = thresholds.best_threshold(thresholds.threshold_sweep(rows, "is_fraud", "probability_1"))
    return thresholds.apply_threshold(rows, "probability_1", best).select("transaction_id", "prediction_best")


@_query
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.regression_metrics(tables.rated(spark, sf), "rating", "prediction"), "rmse", "mae")


@_query
def logit_score(spark: SparkSession, sf: str) -> DataFrame:
    """Probability and prediction of a logistic model with given coefficients."""
    rows = tables.transactions(spark, sf).select("transaction_id", "transaction_amount", "customer_age")
    p = numbers.logistic_probability(["transaction_amount", "customer_age"], [0.02, -0.01], -0.5)
    scored = rows.select("transaction_id", p.alias("probability_1"))
    return _rounded(
        scored.withColumn("prediction", numbers.as_flag(F.col("probability_1") > 0.4)), "probability_1"
    )


# Models


@_query
def fraud_lr(spark: SparkSession, sf: str) -> DataFrame:
    result = fraud.fraud_logistic(tables.transactions(spark, sf), ["transaction_id"])
    return result.predictions.select("transaction_id", "is_fraud", "probability_1", "prediction")


@_query
def fraud_lr_threshold(spark: SparkSession, sf: str) -> DataFrame:
    result = fraud.fraud_logistic(tables.transactions(spark, sf), ["transaction_id"], threshold=0.4)
    return result.predictions.select("transaction_id", "is_fraud", "probability_1", "prediction")


@_query
def fraud_rf(spark: SparkSession, sf: str) -> DataFrame:
    result = fraud.fraud_forest(tables.transactions(spark, sf), ["transaction_id"], depth=5)
    return result.predictions.select("transaction_id", "is_fraud", "probability_1", "prediction_best")


@_query
def fraud_rf_deep(spark: SparkSession, sf: str) -> DataFrame:
    """Sweep of the deeper forest."""
    result = fraud.fraud_forest(tables.transactions(spark, sf), ["transaction_id"], depth=8)
    return result.sweep


@_query
def churn_lr(spark: SparkSession, sf: str) -> DataFrame:
    result = churn.churn_model(
        tables.customers(spark, sf), categorical=tables.CHURN_CATEGORICAL, numeric=tables.CHURN_NUMERIC
    )
    return result.predictions.select("customer_id", "churn_label", "part", "probability_1", "prediction")


@_query
def price_rf(spark: SparkSession, sf: str) -> DataFrame:
    clean = _clean(spark, sf, *tables.SALES_COLUMNS)
    result = sales.price_model(clean, ["order_id"])
    return result.predictions.select("order_id", "qty", "price", "prediction")


@_query
def als_predict(spark: SparkSession, sf: str) -> DataFrame:
    result = recommendations.recommendations(tables.ratings(spark, sf))
    return result.predictions.select("user_id", "product_id", "rating", "prediction", "rounded")


@_query
def top3_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.ratings(spark, sf)
    model = recommend.fit_als(recommend.als(), rows)
    return recommend.flat_recommendations(recommend.top_items(model, 3))


@_query
def disease_rf_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Average recall of every grid point."""
    return disease.disease_model(tables.patients(spark, sf)).grid


@_query
def sentiment_lr(spark: SparkSession, sf: str) -> DataFrame:
    result = sentiment.sentiment_model(tables.posts(spark, sf), tune=False)
    return result.scored.predictions.select("post_id", "sentiment", "prediction", "predicted_label")


def _without_last(model: Model) -> PipelineModel:
    """What a fitted pipeline does ahead of its model."""
    return PipelineModel(model.stages[:-1])


@_query
def sentiment_lr_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Average F1 of every grid point."""
    grid = sentiment.sentiment_model(tables.posts(spark, sf)).grid
    return grid.select("numFeatures", "regParam", "avg_metric")


# What SQL can know of the models' rows


def _same(left: Column, right: Column, within: float = 1e-9) -> Column:
    """Whether two figures agree, relative to their size where that is above one; a null agrees with none."""
    size = F.greatest(F.abs(left), F.abs(right), F.lit(1.0))
    return F.coalesce(F.abs(left - right) <= within * size, F.lit(False))


def _logistic_rows(result: results.Scored, key: str, label: str, limit: float) -> DataFrame:
    """Whether each probability is that of the fitted coefficients, and each prediction
    that of the probability."""
    fitted = result.model.stages[-1]
    values = numbers.vector_to_array("features")
    inputs = [values[i] for i in range(fitted.numFeatures)]
    p = numbers.logistic_probability(inputs, fitted.coefficients.toArray().tolist(), fitted.intercept)
    return result.predictions.select(
        key,
        label,
        _same(p, F.col("probability_1")).alias("from_coefficients"),
        (numbers.as_flag(F.col("probability_1") > limit) == F.col("prediction")).alias("by_threshold"),
    )


@_query
def fraud_lr_rows(spark: SparkSession, sf: str) -> DataFrame:
    result = fraud.fraud_logistic(tables.transactions(spark, sf), ["transaction_id"])
    return _logistic_rows(result, "transaction_id", "is_fraud", 0.5)


@_query
def fraud_lr_threshold_rows(spark: SparkSession, sf: str) -> DataFrame:
    result = fraud.fraud_logistic(tables.transactions(spark, sf), ["transaction_id"], threshold=0.4)
    return _logistic_rows(result, "transaction_id", "is_fraud", 0.4)


@_query
def churn_lr_rows(spark: SparkSession, sf: str) -> DataFrame:
    result = churn.churn_model(
        tables.customers(spark, sf), categorical=tables.CHURN_CATEGORICAL, numeric=tables.CHURN_NUMERIC
    )
    return _logistic_rows(result, "customer_id", "churn_label", 0.5)


@_query
def fraud_rf_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each probability is that of the fitted trees, and each prediction that of the
    probability at the best threshold."""
    result = fraud.fraud_forest(tables.transactions(spark, sf), ["transaction_id"], depth=5)
    best = result.best.select("threshold").scalar()
    again = trees.with_tree_probability(result.predictions, result.model.stages[-1], "again")
    return again.select(
        "transaction_id",
        "is_fraud",
        _same(F.col("again"), F.col("probability_1")).alias("from_trees"),
        (numbers.as_flag(F.col("probability_1") >= best) == F.col("prediction_best")).alias("by_threshold"),
    )


@_query
def fraud_rf_deep_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of each threshold, whether they are those of the probabilities, and whether
    these are all those of the fitted trees."""
    result = fraud.fraud_forest(tables.transactions(spark, sf), ["transaction_id"], depth=8)
    again = trees.with_tree_probability(result.chosen_on, result.model.stages[-1], "again")
    p, fraudulent = F.col("probability_1"), F.col("is_fraud") == 1
    steps = F.transform(F.sequence(F.lit(0), F.lit(100)), lambda i: i.cast("double") * F.lit(0.01))
    above = F.array(*[F.count_if(fraudulent & (p >= F.get(steps, F.lit(i)))) for i in range(101)])
    false = F.array(*[F.count_if(~fraudulent & (p >= F.get(steps, F.lit(i)))) for i in range(101)])
    found = again.agg(F.struct(above.alias("tp"), false.alias("fp"), F.bool_and(_same(F.col("again"), p)).alias("from_trees")))
    one = materialize(found.toDF("of"), "sweep-check").select("of").scalar()
    return result.sweep.select(
        "step",
        (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("fp") + F.col("tn")).alias("negatives"),
        one["from_trees"].alias("from_trees"),
        ((F.get(one["tp"], F.col("step")) == F.col("tp")) & (F.get(one["fp"], F.col("step")) == F.col("fp"))).alias("by_threshold"),
    )


@_query
def price_rf_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each predicted price is the mean of the fitted trees."""
    clean = _clean(spark, sf, *tables.SALES_COLUMNS)
    result = sales.price_model(clean, ["order_id"])
    encoded = _without_last(result.model).transform(result.predictions)
    again = trees.with_tree_prediction(encoded, result.model.stages[-1], "again")
    return again.select("order_id", "qty", "price", _same(F.col("again"), F.col("prediction")).alias("from_trees"))


@_query
def als_predict_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each prediction is the product of the factors of its user and item, as a float."""
    result = recommendations.recommendations(tables.ratings(spark, sf))
    rows = recommend.with_factors(result.predictions, result.model)
    again = linear.dot(F.col("_user_factors"), F.col("_item_factors"))
    return rows.select(
        "user_id",
        "product_id",
        F.round("rating", 9).alias("rating"),
        _same(again, F.col("prediction").cast("double"), 1e-5).alias("from_factors"),
        (F.round("prediction", 2) == F.col("rounded")).alias("rounded_well"),
    )


@_query
def top3_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Users and places; whether a score is that of the factors and below none that follows,
    and whether the items differ."""
    model = recommend.fit_als(recommend.als(), tables.ratings(spark, sf))
    flat = recommend.flat_recommendations(recommend.top_items(model, 3))
    rows = materialize(recommend.with_factors(flat, model), "top-rows")
    again = linear.dot(F.col("_user_factors"), F.col("_item_factors"))
    after = F.lead("rating").over(Window.partitionBy("user_id").orderBy("place"))
    different = F.count("*").over(Window.partitionBy("user_id", "product_id")) == 1
    return rows.select(
        "user_id",
        "place",
        _same(again, F.col("rating").cast("double"), 1e-5).alias("from_factors"),
        F.coalesce(F.col("rating") >= after, F.lit(True)).alias("falls"),
        different.alias("different"),
    )


def _fold_figures(predictions: DataFrame, figure: Column) -> DataFrame:
    """(point, again): the mean over folds of a figure of each fold's rows by class. ``figure``
    is an aggregate over the classes (hit, support, predicted) of a fold."""
    sides = F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.lit(1).alias("own"), F.lit(0).alias("said"), (F.col("label") == F.col("prediction")).cast("int").alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).alias("own"), F.lit(1).alias("said"), F.lit(0).alias("hit")),
    ))
    by_class = predictions.select("point", "fold", sides.alias("of")).groupBy("point", "fold", "of.class").agg(
        F.sum("of.hit").alias("hit"), F.sum("of.own").alias("support"), F.sum("of.said").alias("predicted")
    )
    return by_class.groupBy("point", "fold").agg(figure.alias("figure")).groupBy("point").agg(F.avg("figure").alias("again"))


def _grid_rows(search: tuning.GridSearch, figure: Column, columns: dict[str, str]) -> DataFrame:
    """Grid points with whether their average is that of their stored fold predictions."""
    again = _fold_figures(search.predictions, figure)
    points = [
        (i, float(average), *[{p.name: v for p, v in point.items()}[c] for c in columns])
        for i, (point, average) in enumerate(zip(search.points, search.averages, strict=True))
    ]
    kinds = ", ".join(f"{c} {kind}" for c, kind in columns.items())
    listed = again.sparkSession.createDataFrame(points, f"point int, avg_metric double, {kinds}")
    joined = listed.join(again, "point", "left")
    return joined.select(*columns, _same(F.col("again"), F.col("avg_metric")).alias("from_folds"))


@_query
def disease_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each probability is that of the trees of the best forest, here of a small grid."""
    result = disease.disease_model(tables.patients(spark, sf), trees=(5, 10), depths=(3, 4))
    again = trees.with_tree_probability(result.scored.predictions, result.scored.model.stages[-1], "again")
    return again.select(
        "patient_id",
        "disease",
        _same(F.col("again"), F.col("probability_1")).alias("from_trees"),
        (numbers.as_flag(F.col("probability_1") > 0.5) == F.col("prediction")).alias("by_threshold"),
    )


@_query
def disease_grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each average is the recall of class 1 in the fold predictions."""
    search = disease.disease_model(tables.patients(spark, sf)).search
    recall = F.max(F.when(F.col("class") == 1, F.col("hit") / F.greatest(F.col("support"), F.lit(1))))
    return _grid_rows(search, F.coalesce(recall, F.lit(0.0)), {"numTrees": "bigint", "maxDepth": "bigint"})


@_query
def sentiment_lr_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the probabilities are those of the fitted coefficients, the prediction is the
    likeliest class, and the label is its name."""
    result = sentiment.sentiment_model(tables.posts(spark, sf), tune=False).scored
    words = text.ml_words(result.predictions, "post_text", "filtered_words")
    encoded = _without_last(result.model).transform(words)
    weights = linear.class_weights_table(encoded, result.model.stages[-1])
    rows = linear.with_softmax(encoded, weights, "again")
    given = numbers.vector_to_array("probability")
    pairs = F.zip_with("again", given, lambda a, b: _same(a, b))
    return rows.select(
        "post_id",
        "sentiment",
        (F.forall(pairs, lambda same: same) & (F.size("again") == F.size(given))).alias("from_coefficients"),
        (linear.likeliest(F.col("again")) == F.col("prediction")).alias("likeliest"),
        F.col("predicted_label").isin("positive", "negative", "neutral").alias("known_label"),
    )


@_query
def sentiment_grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each average is the weighted F1 of the fold predictions."""
    search = sentiment.sentiment_model(tables.posts(spark, sf)).search
    hit, support, said = F.col("hit"), F.col("support"), F.col("predicted")
    # 2pr / (p + r) of p = hit / said and r = hit / support.
    f1 = F.when(support + said > 0, 2 * hit / (support + said)).otherwise(F.lit(0.0))
    return _grid_rows(search, F.sum(f1 * support) / F.sum(support), {"numFeatures": "bigint", "regParam": "double"})


@_query
def hashing_tf_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed counts of each document in all, beside its words."""
    words = text.ml_words(tables.texts(spark, sf), "post_text", "words")
    buckets = text.filled_buckets(text.hashing_tf("words", "counts").transform(words), "post_id", "counts")
    return buckets.groupBy("post_id").agg(F.sum("tf").cast("bigint").alias("n_words"))
