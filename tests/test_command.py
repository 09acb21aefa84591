"""Jobs from CSV file to result folder, as the command runs them."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright import __main__ as command
from tallywright.sources import readers, schemas
from tallywright.sources.scratch import scratch_root
from tallywright.sources.writers import write_csv


def write_rows(spark, path, schema, columns, n=300):
    """Rows of a schema, numbered by id."""
    names = [c.split()[0] for c in schema.split(", ")]
    write_csv(spark.range(n).select(*[columns[name].alias(name) for name in names]), str(path))


def scratch_files(spark):
    folder = f"{scratch_root(spark)}/tallywright"
    return os.listdir(folder) if os.path.exists(folder) else []


def mod(n):
    return F.col("id") % n


@pytest.fixture
def transactions(spark, tmp_path):
    write_rows(
        spark,
        tmp_path / "in",
        schemas.TRANSACTIONS,
        {
            "transaction_id": F.col("id"),
            "transaction_time": F.lit("13-01-2024 10:20"),
            "transaction_amount": (F.lit(10) + mod(90)).cast("double"),
            "merchant": F.concat(F.lit("m"), mod(3).cast("string")),
            "customer_age": F.lit(20) + mod(40),
            "customer_region": F.concat(F.lit("r"), mod(4).cast("string")),
            "is_fraud": (mod(90) > 70).cast("int"),
        },
    )
    return tmp_path


@pytest.mark.parametrize("infer", [False, True])
def test_fraud(spark, transactions, infer):
    out = str(transactions / "out")
    command.run(spark, "fraud-logistic", str(transactions / "in"), out, infer)
    rows = readers.read_parquet(spark, f"{out}/rows")
    assert rows.filter("transaction_time is null").count() == 0
    assert sum(r["n_rows"] for r in spark.read.json(f"{out}/confusion").collect()) == rows.count()


def test_header_must_fit_the_schema(spark, transactions):
    other = schemas.TRANSACTIONS.replace("merchant", "shop")
    with pytest.raises(Exception) as caught:
        readers.read_csv(spark, str(transactions / "in"), other).collect()
    assert "header" in str(caught.value).lower() or isinstance(caught.value, PySparkException)


def test_sales_cleaning(spark, tmp_path):
    text = F.concat(F.lit("x"), mod(3).cast("string"))
    columns = {name: text for name in ("store_id", "product", "category", "city")}
    columns |= {
        "order_id": F.col("id"),
        "quantity": F.when(mod(10) != 0, 2),
        "price": F.lit(5),
        "sales_amount": F.lit(10),
        "order_date": F.lit("1/5/2024"),
    }
    write_rows(spark, tmp_path / "in", schemas.SALES_RAW, columns)
    command.run(spark, "clean-sales", str(tmp_path / "in"), str(tmp_path / "out"))
    rows = readers.read_parquet(spark, str(tmp_path / "out" / "rows"))
    assert rows.count() == 270
    assert rows.schema["order_date"].dataType.simpleString() == "date"


def test_sales_report(spark, tmp_path):
    columns = {
        "order_id": F.col("id"),
        "customer_id": mod(40),
        "order_date": F.when(mod(2) == 0, "13-01-2024").otherwise("2/14/2024"),
        "city": F.when(mod(5) != 0, F.concat(F.lit("c"), mod(3).cast("string"))),
        "category": F.lit("toys"),
        "price": (F.lit(10) + mod(3) * 5).cast("double"),
        "qty": (F.lit(1) + mod(4)).cast("double"),
        "discount_pct": F.lit(None).cast("double"),
        "payment_method": F.when(mod(2) == 0, "card").otherwise("cash"),
        "order_status": F.when(mod(7) == 0, "open").otherwise("done"),
    }
    write_rows(spark, tmp_path / "in", schemas.SALES, columns)
    out = str(tmp_path / "out")
    command.run(spark, "sales-report", str(tmp_path / "in"), out)
    months = readers.read_csv(spark, f"{out}/monthly_revenue").orderBy("month").collect()
    assert [(r["year"], r["month"]) for r in months] == [(2024, 1), (2024, 2)]
    assert spark.read.json(f"{out}/repeat_rate").first()["repeat_rate"] == 100.0
    assert readers.read_csv(spark, f"{out}/price_predictions").columns == ["qty", "price", "prediction"]


def test_recommendations(spark, tmp_path):
    columns = {
        "user_id": (F.col("id") / 15).cast("int"),
        "product_id": mod(15),
        "rating": F.lit(1) + mod(5),
        "timestamp": F.lit(0),
    }
    write_rows(spark, tmp_path / "in", schemas.RATINGS, columns)
    before = set(scratch_files(spark))
    command.run(spark, "recommendations", str(tmp_path / "in"), str(tmp_path / "out"))
    top = spark.read.json(str(tmp_path / "out" / "top"))
    assert set(scratch_files(spark)) == before
    assert top.groupBy("user_id").count().filter("count <> 3").count() == 0


def test_each_job_has_a_schema_spark_can_read(spark):
    for schema, _ in command.JOBS.values():
        assert spark.createDataFrame([], schema).columns
