"""Fraud jobs: logistic regression and random forest with a tuned threshold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators import balance, cleaning, features, indexing, metrics, models, split, thresholds
from tallywright.operators.counting import StageCounts, marked
from tallywright.plans.results import Scored, classified, stored

LABEL = "is_fraud"
NUMERIC = ("transaction_amount", "customer_age")
CATEGORICAL = ("merchant", "customer_region")


def clean_transactions(
    df: DataFrame, subset: Sequence[str] | None = None, counts: StageCounts | None = None
) -> DataFrame:
    """Complete rows with the time parsed and an amount above zero. ``counts`` get the rows
    loaded, complete, positive, and of these fraud and genuine, as they pass."""
    complete = marked(cleaning.drop_nulls(marked(df, counts, "loaded"), subset), counts, "complete")
    timed = cleaning.parse_timestamps(complete, "transaction_time")
    positive = cleaning.keep_positive(timed, "transaction_amount")
    return marked(positive, counts, "positive", fraud=F.col(LABEL) == 1, genuine=F.col(LABEL) == 0)


def prepared(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    complete: str = "needed",
    counts: StageCounts | None = None,
) -> DataFrame:
    """Clean rows with "unknown" for a missing category.

    ``complete="needed"`` drops rows without a label or a number; ``"all"`` drops
    those with a null in any column, before anything is filled.
    """
    if complete not in ("needed", "all"):
        raise ValueError("complete is needed or all")
    subset = [LABEL, *NUMERIC] if complete == "needed" else None
    return cleaning.fill_present(clean_transactions(df, subset, counts), categorical)


def _encoder(
    df: DataFrame, categorical: Sequence[str], wide: Sequence[str], spread: str
) -> tuple[DataFrame, list, list[str]]:
    """Stages that turn the columns into a vector. A category the source lacks
    becomes the constant 0."""
    present = [c for c in categorical if c in df.columns]
    for name in categorical:
        if name not in present:
            df = cleaning.with_column_or(df, f"{name}_index", f"{name}_index")
    outputs = [f"{c}_index" for c in present]
    stages = indexing.indexers(present, outputs, wide, spread)
    inputs = [*NUMERIC, *[f"{c}_index" for c in categorical]]
    used = [*NUMERIC, *present, *[f"{c}_index" for c in categorical if c not in present]]
    return df, [*stages, features.assembler(inputs)], used


def fraud_logistic(
    df: DataFrame,
    keys: Sequence[str],
    categorical: Sequence[str] = CATEGORICAL,
    threshold: float | None = None,
    balance_first: bool = False,
    complete: str = "needed",
    seed: int = 42,
    partitions: int | None = None,
    wide: Sequence[str] = (),
    output: str | None = None,
) -> Scored:
    """Logistic regression on oversampled training rows.

    ``complete`` is that of ``prepared``. By default the rows are split before they are balanced, so that no copy of
    a training row is tested on. ``balance_first`` swaps the two steps. ``wide`` names
    categories of very many values, which are indexed by tables.
    """
    rows, stages, used = _encoder(prepared(df, categorical, complete), categorical, wide, keys[0])
    if balance_first:
        balanced = balance.oversample_minority(rows, LABEL, keys, seed, copy_column="_copy")
        train, test = split.hash_split(balanced, [*keys, "_copy"], (0.8, 0.2), seed)
    else:
        train, test = split.hash_split(rows, keys, (0.8, 0.2), seed)
        train = balance.oversample_minority(train, LABEL, keys, seed)
    pipeline = Pipeline(stages=[*stages, models.logistic(LABEL, 10, threshold)])
    model = models.fit(pipeline, train, [*used, LABEL], keys, partitions)
    predictions = stored(models.with_class_probability(model.transform(test)), "fraud-logistic", output)
    return classified(model, predictions, LABEL)


@dataclass(frozen=True)
class ForestResult:
    model: Model
    predictions: DataFrame
    sweep: DataFrame
    best: DataFrame
    confusion: DataFrame
    report: DataFrame
    recall: DataFrame
    # The scored rows on which the threshold was chosen.
    chosen_on: DataFrame


def fraud_forest(
    df: DataFrame,
    keys: Sequence[str],
    categorical: Sequence[str] = CATEGORICAL,
    trees: int = 100,
    depth: int = 5,
    balancing: str = "weights",
    threshold_on: str = "validation",
    complete: str = "needed",
    seed: int = 42,
    partitions: int | None = None,
    wide: Sequence[str] = (),
    output: str | None = None,
    counts: StageCounts | None = None,
) -> ForestResult:
    """Random forest, and the threshold with the best weighted F1.

    ``balancing`` is ``weights``, ``oversample`` or ``both``; it touches the
    training rows only. The threshold is chosen on rows of its own
    (``validation``) or on those it is reported for (``test``). ``counts`` get the rows of
    each stage of cleaning while the clean rows are stored. ``wide`` names categories of
    very many values, which are indexed by tables and taken as numbers.
    """
    if balancing not in ("weights", "oversample", "both") or threshold_on not in ("validation", "test"):
        raise ValueError("balancing is weights, oversample or both; threshold_on is validation or test")
    rows, stages, used = _encoder(prepared(df, categorical, complete, counts), categorical, wide, keys[0])
    with_validation = threshold_on == "validation"
    weights = (0.64, 0.16, 0.2) if with_validation else (0.8, 0.2)
    # Stored once with the part of each row: weights, fit, threshold and test all read it.
    rows = stored(split.with_part(rows, keys, "_part", weights, seed), "fraud-rows")
    train, *held_out = [rows.filter(F.col("_part") == i).drop("_part") for i in range(len(weights))]
    if balancing != "weights":
        train = balance.oversample_minority(train, LABEL, keys, seed)
    weight = None
    if balancing != "oversample":
        weight = "class_weight_col"
        train = balance.with_binary_weights(train, LABEL, weight)
    forest = models.forest_classifier(LABEL, trees, depth, weight, seed)
    columns = [*used, LABEL, *([weight] if weight else [])]
    model = models.fit(Pipeline(stages=[*stages, forest]), train, columns, keys, partitions)

    def score(part: DataFrame) -> DataFrame:
        return models.with_class_probability(model.transform(part))

    test = score(held_out[-1])
    if with_validation:
        chosen_on = stored(score(held_out[0]).select(*keys, LABEL, "features", "probability_1"), "fraud-validation")
    else:
        chosen_on = test = stored(test, "fraud-scores")
    sweep = thresholds.threshold_sweep(chosen_on, LABEL, "probability_1")
    best = thresholds.best_threshold(sweep)
    final = stored(thresholds.apply_threshold(test, "probability_1", best), "fraud-forest", output)
    return ForestResult(
        model,
        final,
        sweep,
        best,
        metrics.confusion_matrix(final, LABEL, "prediction_best"),
        metrics.classification_report(final, LABEL, "prediction_best"),
        metrics.positive_recall(final, LABEL, "prediction_best"),
        chosen_on,
    )
