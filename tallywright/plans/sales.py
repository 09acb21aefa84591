"""Sales jobs: cleaning, analytics, and a price model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import ISO_DATE_FORMAT, SALES_DATE_FORMATS
from tallywright.functions.numbers import money
from tallywright.operators import aggregates, cleaning, features, indexing, metrics, models, split
from tallywright.operators.counting import StageCounts, marked
from tallywright.plans.results import stored
from tallywright.sources.writers import write_csv, write_parquet

# The columns of the sales file.
CATEGORICAL = ("city", "payment_method", "order_status")
NUMERIC = ("qty", "discount_pct", "month", "day", "day_of_week")
# What stands in for a null.
DEFAULTS = {"discount_pct": 0, "city": "Unknown", "payment_method": "Unknown", "order_status": "Unknown"}


def clean_raw_sales(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    formats: Sequence[str] = (*SALES_DATE_FORMATS, ISO_DATE_FORMAT),
    require_parsed: bool = False,
    output: str | None = None,
    counts: StageCounts | None = None,
) -> DataFrame:
    """Complete rows with a parsed date and a price above zero. ``counts`` get the rows
    loaded, complete and clean, as they pass."""
    complete = marked(cleaning.drop_nulls(marked(df, counts, "loaded"), subset), counts, "complete")
    parsed = cleaning.repair_dates(complete, "order_date", formats, require_parsed)
    clean = marked(cleaning.keep_positive(parsed, "price"), counts, "clean")
    if output is not None:
        write_parquet(clean, output)
    return clean


def clean_sales(
    df: DataFrame, formats: Sequence[str] = SALES_DATE_FORMATS, counts: StageCounts | None = None
) -> DataFrame:
    """Rows with a readable date and positive price and quantity, with date
    parts and revenue to the cent, and defaults for what is missing. ``counts`` get the
    rows loaded, dated and clean, as they pass."""
    dated = marked(cleaning.repair_dates(marked(df, counts, "loaded"), "order_date", formats), counts, "dated")
    positive = marked(cleaning.keep_positive(dated, "price", "qty"), counts, "clean")
    parts = cleaning.add_date_parts(positive, "order_date")
    priced = parts.withColumn("revenue", money(F.col("price") * F.col("qty")))
    return cleaning.fill_nulls(priced, {c: v for c, v in DEFAULTS.items() if c in df.columns})


@dataclass(frozen=True)
class SalesReport:
    top_cities: DataFrame
    top_category: DataFrame
    repeat_rate: DataFrame
    monthly_revenue: DataFrame


def sales_report(clean: DataFrame, output: str | None = None) -> SalesReport:
    """The four figures of cleaned sales. With ``output`` the two reports that
    are kept go there as single CSV files; they hold five rows, and one per month."""
    report = SalesReport(
        top_cities=aggregates.top_groups(clean, "city", "revenue", "total_revenue", 5),
        top_category=aggregates.top_groups(clean, "category", "qty", "total_quantity", 1),
        repeat_rate=aggregates.repeat_rate(clean, "customer_id", "order_id"),
        monthly_revenue=aggregates.monthly_totals(clean, "order_date", "revenue", "monthly_revenue"),
    )
    if output is not None:
        write_csv(report.top_cities, f"{output}/top_cities", single_file=True)
        write_csv(report.monthly_revenue, f"{output}/monthly_revenue", single_file=True)
    return report


@dataclass(frozen=True)
class PriceModel:
    model: Model | None
    predictions: DataFrame
    metrics: DataFrame


def price_model(
    clean: DataFrame,
    keys: Sequence[str],
    trees: int = 50,
    depth: int = 6,
    seed: int = 42,
    partitions: int | None = None,
    output: str | None = None,
) -> PriceModel:
    """Random forest of the price by place, payment, status, quantity and date.

    The columns needed are stored once with the part of each row, as checks, fit and scoring
    all read them. Without two values in every category, or without training rows, there
    is no model and the result is empty.
    """
    columns = [*CATEGORICAL, *NUMERIC, "price"]
    needed = clean.select(*keys, *[c for c in columns if c not in keys])
    parted = stored(split.with_part(needed, keys, "_part", (0.8, 0.2), seed), "sales")
    clean, train, test = [df.drop("_part") for df in (parted, parted.filter("_part = 0"), parted.filter("_part = 1"))]
    if not aggregates.has_variety(clean, CATEGORICAL) or split.is_empty(train):
        nothing = clean.limit(0).withColumn("prediction", F.lit(None).cast("double"))
        return PriceModel(None, nothing, metrics.regression_metrics(nothing, "price", "prediction"))
    indices, vectors = [f"{c}_index" for c in CATEGORICAL], [f"{c}_vec" for c in CATEGORICAL]
    pipeline = Pipeline(
        stages=[
            indexing.string_indexer(CATEGORICAL, indices, "keep"),
            OneHotEncoder(inputCols=indices, outputCols=vectors),
            features.assembler([*NUMERIC, *vectors], handle_invalid="keep"),
            models.forest_regressor("price", trees, depth, seed),
        ]
    )
    model = models.fit(pipeline, train, columns, keys, partitions)
    scored = model.transform(test).drop("features", *indices, *vectors)
    predictions = stored(scored, "price-predictions")
    if output is not None:
        write_csv(predictions.select("qty", "price", "prediction"), output)
    return PriceModel(model, predictions, metrics.regression_metrics(predictions, "price", "prediction"))
