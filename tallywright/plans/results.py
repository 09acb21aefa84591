"""Results of the jobs, and how their predictions are stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame

from tallywright.operators import metrics
from tallywright.sources.scratch import materialize
from tallywright.sources.writers import write_parquet


@dataclass(frozen=True)
class Scored:
    """A fitted model, its stored predictions, and their evaluation."""

    model: Model
    predictions: DataFrame
    confusion: DataFrame
    report: DataFrame


def stored(df: DataFrame, name: str, output: str | None = None) -> DataFrame:
    """The rows written once, at ``output`` or in the scratch folder, and read
    back: whatever evaluates them does not score them again."""
    if output is None:
        return materialize(df, name)
    write_parquet(df, output)
    return df.sparkSession.read.schema(df.schema).parquet(output)


def classified(model: Model, predictions: DataFrame, label: str, prediction: str = "prediction") -> Scored:
    return Scored(
        model,
        predictions,
        metrics.confusion_matrix(predictions, label, prediction),
        metrics.classification_report(predictions, label, prediction),
    )
