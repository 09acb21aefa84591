from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tallywright.functions import dates
from tallywright.operators import aggregates, cleaning

D = datetime.date


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("13-01-2024", D(2024, 1, 13)),
        ("1/5/2024", D(2024, 1, 5)),
        ("01/05/2024", D(2024, 1, 5)),
        ("2024-01-05", None),
        ("1-5-2024", None),
        ("13/1/2024", None),
        ("", None),
        ("no date", None),
        (None, None),
    ],
)
def test_repaired_dates(spark, text, date):
    df = spark.createDataFrame([(1, text)], "id int, order_date string")
    assert values(cleaning.repair_dates(df, "order_date", require_parsed=False), "order_date") == [date]
    assert cleaning.repair_dates(df, "order_date").count() == (date is not None)


def test_separator_check_changes_no_result(spark):
    texts = ["13-01-2024", "1/5/2024", "2024-01-05", "31/12/2023", "12/31/2023", "2023-12-31", "x", "-", "/", "//"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fmt in (*dates.SALES_DATE_FORMATS, dates.ISO_DATE_FORMAT):
        pair = df.select(dates.parse_date(F.col("t"), fmt).alias("a"), F.try_to_date("t", fmt).alias("b"))
        assert all(r["a"] == r["b"] for r in pair.collect())


def test_date_columns_are_only_cast(spark):
    df = spark.sql("select date'2024-03-01' as order_date, timestamp'2024-03-01 10:00:00' as t")
    assert values(cleaning.repair_dates(df, "order_date"), "order_date") == [D(2024, 3, 1)]
    assert values(cleaning.repair_dates(df, "t"), "t") == [D(2024, 3, 1)]
    assert cleaning.parse_timestamps(df, "t").schema["t"].dataType.simpleString() == "timestamp"


def test_timestamps_of_both_notations(spark):
    rows = [("2024-01-13 10:20:30",), ("13-01-2024 10:20",), ("13.01.2024",), (None,)]
    parsed = cleaning.parse_timestamps(spark.createDataFrame(rows, "t string"), "t")
    assert values(parsed, "t") == [
        datetime.datetime(2024, 1, 13, 10, 20, 30),
        datetime.datetime(2024, 1, 13, 10, 20),
        None,
        None,
    ]


def test_sunday_is_the_first_day(spark):
    df = spark.sql("select date'2024-03-03' as d")
    assert cleaning.add_date_parts(df, "d").first().asDict() == {
        "d": D(2024, 3, 3),
        "month": 3,
        "day": 3,
        "day_of_week": 1,
    }


def test_drop_nulls_takes_nan_too(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert values(cleaning.drop_nulls(df), "y") == ["a"]
    assert values(cleaning.drop_nulls(df, ["x"]), "y") == ["a", None]


def test_fill_nulls_takes_nan_too(spark):
    df = spark.createDataFrame([(None, None), (math.nan, "b")], "x double, y string")
    assert [tuple(r) for r in cleaning.fill_nulls(df, {"x": 0, "y": "Unknown"}).collect()] == [
        (0.0, "Unknown"),
        (0.0, "b"),
    ]


def test_fill_present_ignores_missing_columns(spark):
    df = spark.createDataFrame([(None,)], "merchant string")
    assert values(cleaning.fill_present(df, ["merchant", "customer_region"]), "merchant") == ["unknown"]
    assert cleaning.fill_present(df, ["customer_region"]) is df


def test_positive_leaves_out_null_and_zero(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (None, 1), (-1, 1)], "price int, qty int")
    assert cleaning.keep_positive(df, "price", "qty").count() == 1


def test_cast_of_bad_text_is_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "a string")
    assert values(cleaning.cast_numeric(df, ["a"]), "a") == [1.5, None, None]


def test_label_of_other_text_is_zero(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("y",), (None,)], "churn string")
    assert values(cleaning.label_from_text(df, "churn", "l"), "l") == [1, 0, 0, 0]


def test_missing_column_falls_back(spark):
    df = spark.createDataFrame([(5.0,)], "a double")
    assert values(cleaning.with_column_or(df, "merchant", "m"), "m") == [0.0]
    assert values(cleaning.with_column_or(df, "a", "m"), "m") == [5.0]


def test_preview_is_ordered_and_needs_no_sort(spark):
    df = spark.range(100).repartition(7)
    head = cleaning.preview(df, ["id"], 3)
    assert values(head, "id") == [0, 1, 2]
    assert "TakeOrdered" in head._jdf.queryExecution().toString()


def test_stage_counts_do_not_count_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "y int")
    counts = cleaning.stage_counts(df, {"all": F.lit(True), "ones": F.col("y") == 1, "none": F.col("y") > 5})
    assert [tuple(r) for r in counts.collect()] == [("all", 3), ("ones", 1), ("none", 0)]


def test_top_groups_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, v int")
    assert values(aggregates.top_groups(df, "k", "v", "t", 2), "k") == ["a", "b"]


def test_repeat_rate(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (2, 12), (3, 13), (4, 14)], "c int, o int")
    assert aggregates.repeat_rate(df, "c", "o").first()["repeat_rate"] == 25.0
    assert aggregates.repeat_rate(df.limit(0), "c", "o").first()["repeat_rate"] == 0.0


def test_variety_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("x", "p", None), ("x", None, None)], "a string, b string, c string")
    got = {r["column_name"]: (r["distinct_values"], r["enough"]) for r in aggregates.distinct_guard(df, "abc").collect()}
    assert got == {"a": (1, False), "b": (2, True), "c": (1, False)}
    assert not aggregates.has_variety(df, ["a"])
    assert aggregates.has_variety(df, ["b"])
    assert not aggregates.has_variety(df, ["c"])
    assert not aggregates.has_variety(df.limit(0), ["a"])


def test_group_totals_are_combined_before_the_shuffle(spark):
    plan = aggregates.group_totals(spark.range(10).selectExpr("id % 2 k", "id v"), ["k"], "v", "t")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and text.count("Exchange") == 1
