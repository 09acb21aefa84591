"""Scores of fitted linear and factor models, computed from their stored numbers by Spark's own expressions."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize


def filled_entries(vector: Column) -> Column:
    """(index, value) of a vector: of a sparse one those it stores, of a dense one all."""
    parts = F.unwrap_udt(vector)
    every = F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    index = F.coalesce(parts["indices"], every)
    return F.arrays_zip(index.alias("index"), parts["values"].alias("value"))


def class_weights_table(df: DataFrame, model: Model) -> DataFrame:
    """(class, intercept, weights): the coefficients of a logistic model by class, as a stored
    table. A model of two classes has those of class 1, and zeros for class 0."""
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(i, float(b), [float(x) for x in w]) for i, (b, w) in enumerate(zip(intercepts, matrix, strict=True))]
    if model.numClasses == 2:
        rows = [(0, 0.0, [0.0] * model.numFeatures), (1, *rows[0][1:])]
    table = df.sparkSession.createDataFrame(rows, "class int, intercept double, weights array<double>")
    return materialize(table, "class_weights")


def with_softmax(df: DataFrame, weights: DataFrame, output: str, features: str = "features") -> DataFrame:
    """An array of the probabilities of the classes: exp(b + w.x) over the sum of all classes.
    The largest margin is taken off first, so no exponential is too large."""
    classes = weights.agg(F.sort_array(F.collect_list(F.struct("class", "intercept", "weights"))).alias("all"))
    own = [F.col(f"`{c}`") for c in df.columns]

    def margins(entries: Column) -> Column:
        def margin(of: Column) -> Column:
            return F.aggregate(entries, of["intercept"], lambda sum_, e: sum_ + e["value"] * F.get(of["weights"], e["index"]))

        return F.transform("_classes", margin)

    # The coefficients are named once and dropped at once: so they are read in place, not copied to each row.
    at_hand = df.withColumn("_classes", classes.select("all").scalar())
    found = F.get(F.transform(F.array(filled_entries(F.col(features))), margins), F.lit(0))
    with_margins = at_hand.select(*own, found.alias("_margins"))
    powers = with_margins.select(*own, F.transform("_margins", lambda m: F.exp(m - F.array_max("_margins"))).alias("_powers"))
    total = F.aggregate("_powers", F.lit(0.0), lambda a, b: a + b)
    return powers.select(*own, F.transform("_powers", lambda p: p / total).alias(output))


def likeliest(probabilities: Column) -> Column:
    """The number of the class of the largest probability, of equal ones the first."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("double")


def dot(left: Column, right: Column) -> Column:
    """The inner product of two arrays of numbers, in doubles."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)
