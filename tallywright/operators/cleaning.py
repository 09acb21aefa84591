"""Null handling, filters, casts and parsed dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tallywright.functions import dates
from tallywright.functions.numbers import binary_label


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN in ``subset``, by default in any column.

    Name the subset where it is known: without it every column of the source
    must be read, also those nothing else uses.
    """
    return df.dropna("any", subset=list(subset) if subset is not None else None)


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """A value for null (and NaN) per column."""
    return df.fillna(dict(values))


def fill_present(df: DataFrame, columns: Sequence[str], value: str = "unknown") -> DataFrame:
    """Fill those of ``columns`` which the frame has; the others are ignored."""
    present = {c: value for c in columns if c in df.columns}
    return df.fillna(present) if present else df


def keep_positive(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the named columns are above zero."""
    keep = F.lit(True)
    for name in columns:
        keep = keep & (F.col(name) > 0)
    return df.filter(keep)


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as double; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def label_from_text(df: DataFrame, column: str, output: str, positive: str = "Y") -> DataFrame:
    return df.withColumn(output, binary_label(F.col(column), positive))


def with_column_or(df: DataFrame, name: str, output: str, default: object = 0.0) -> DataFrame:
    """``output`` copied from ``name``, or a constant where the source lacks it."""
    value = F.col(name) if name in df.columns else F.lit(default)
    return df.withColumn(output, value)


def _is_temporal(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, DateType | TimestampType | TimestampNTZType)


def repair_dates(
    df: DataFrame,
    column: str,
    formats: Sequence[str] = dates.SALES_DATE_FORMATS,
    require_parsed: bool = True,
) -> DataFrame:
    """Replace date text by dates; rows without a match are dropped on request.

    A column that is a date or timestamp already is only cast.
    """
    text = F.col(column)
    parsed = text.cast("date") if _is_temporal(df, column) else dates.repair_date(text, formats)
    if not require_parsed:
        return df.withColumn(column, parsed)
    # As an array of one date or none: a filter on the date would have it parsed twice.
    found = df.withColumn("_parsed", F.explode(F.array_compact(F.array(parsed))))
    return found.select(*[F.col("_parsed").alias(c) if c == column else F.col(c) for c in df.columns])


def parse_timestamps(
    df: DataFrame,
    column: str,
    formats: Sequence[str] = dates.TIMESTAMP_FORMATS,
    require_parsed: bool = False,
) -> DataFrame:
    """Replace timestamp text by timestamps; no match gives null."""
    parsed = df if _is_temporal(df, column) else df.withColumn(column, dates.parse_timestamp(F.col(column), formats))
    return parsed.filter(F.col(column).isNotNull()) if require_parsed else parsed


def add_date_parts(df: DataFrame, column: str) -> DataFrame:
    """Month, day of the month, and day of the week with Sunday as 1."""
    when = F.col(column)
    return df.withColumns(
        {"month": F.month(when), "day": F.dayofmonth(when), "day_of_week": F.dayofweek(when)}
    )


def add_product(df: DataFrame, left: str, right: str, output: str) -> DataFrame:
    return df.withColumn(output, F.col(left) * F.col(right))


def preview(df: DataFrame, keys: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows by key, found without a full sort."""
    return df.orderBy(*keys).limit(rows)


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """One row per stage with the rows that pass it, all from a single pass.

    A condition that is null does not pass.
    """
    totals = df.agg(*[F.count_if(cond).alias(name) for name, cond in stages.items()])
    pairs = [F.struct(F.lit(name).alias("stage"), F.col(name).alias("n_rows")) for name in stages]
    return totals.select(F.inline(F.array(*pairs)))
