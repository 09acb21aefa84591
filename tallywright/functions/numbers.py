"""Numeric, label and probability expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    """Amount to the cent; sums of it are exact and independent of row order."""
    return value.cast("decimal(18,2)")


def binary_label(column: Column, positive: str = "Y") -> Column:
    """1 for the positive text; 0 for null and any other text."""
    return F.when(column == positive, 1).otherwise(0)


def as_flag(condition: Column) -> Column:
    """Boolean as 0.0 / 1.0."""
    return condition.cast("double")


def class_probability(column: str | Column, position: int = 1) -> Column:
    """One entry of a probability vector, read inside the JVM."""
    return vector_to_array(column)[position]


def logistic_probability(features: Sequence[str | Column], weights: Sequence[float], intercept: float) -> Column:
    """1 / (1 + exp(-(b + w.x))) with the terms added from left to right."""
    margin = F.lit(float(intercept))
    for name, weight in zip(features, weights, strict=True):
        margin = margin + (F.col(name) if isinstance(name, str) else name) * F.lit(float(weight))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
