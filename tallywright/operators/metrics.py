"""Evaluation. Each metric comes from one aggregate over the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, names: Sequence[str] | None = None, count: str = "n_rows"
) -> DataFrame:
    """Count of each pair (actual, predicted) that occurs."""
    a, p = names or (actual, predicted)
    return df.groupBy(F.col(actual).alias(a), F.col(predicted).alias(p)).agg(F.count(F.lit(1)).alias(count))


def _class_rows(cells: DataFrame) -> DataFrame:
    """Per class: true positives, rows of the class, rows predicted as it.

    Reads the cells of the confusion matrix, which are few, and adds each to
    its actual and to its predicted class.
    """
    zero = F.lit(0).cast("bigint")
    n = F.when(F.col("a").isNotNull() & F.col("p").isNotNull(), F.col("n_rows")).otherwise(zero)
    hit = F.when(F.col("a") == F.col("p"), n).otherwise(zero)
    as_actual = F.struct(
        F.col("a").alias("class"), hit.alias("tp"), n.alias("support"), zero.alias("predicted")
    )
    as_predicted = F.struct(
        F.col("p").alias("class"), zero.alias("tp"), zero.alias("support"), n.alias("predicted")
    )
    return (
        cells.select(F.inline(F.array(as_actual, as_predicted)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
        .filter(F.col("support") + F.col("predicted") > 0)
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def per_class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall and F1 of every class that occurs or is predicted.

    Rows without label or prediction are left out, by their cells: a filter on
    the rows would have a model that is not yet stored score each row twice.
    """
    cells = (
        df.groupBy(F.col(label).cast("double").alias("a"), F.col(prediction).cast("double").alias("p"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return (
        _class_rows(cells)
        .withColumns({"precision": _ratio(tp, predicted), "recall": _ratio(tp, support)})
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by the share of each class."""
    support = F.col("support")
    total = F.sum(support)

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * support) / total

    return per_class_metrics(df, label, prediction).agg(
        (F.sum("tp") / total).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("f1"),
    )


def positive_recall(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tp / max(tp + fn, 1) of the class 1, with its counts."""
    actual, predicted = F.col(label) == 1, F.col(prediction)
    counts = df.agg(
        F.count_if(actual & (predicted == 1)).alias("tp"),
        F.count_if(actual & (predicted == 0)).alias("fn"),
    )
    return counts.withColumn("recall", F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1)))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE and MAE of the rows with both values."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.count(error).alias("n_rows")
    )


def with_rounded(df: DataFrame, column: str, output: str, digits: int = 2) -> DataFrame:
    """Rounded half away from zero; a float stays a float."""
    return df.withColumn(output, F.round(F.col(column), digits))
