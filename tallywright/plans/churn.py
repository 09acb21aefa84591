"""Churn job: logistic regression on customer figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame

from tallywright.operators import cleaning, features, indexing, models, split
from tallywright.plans.results import Scored, classified, stored

LABEL = "churn_label"
# The columns of the customer file.
CATEGORICAL = (
    "gender",
    "partner",
    "dependents",
    "phone_service",
    "internet_service",
    "contract_type",
    "payment_method",
)
NUMERIC = (
    "senior_citizen",
    "tenure_months",
    "monthly_charges",
    "total_charges",
    "avg_monthly_usage",
    "complaints",
)


def churn_model(
    df: DataFrame,
    keys: Sequence[str] = ("customer_id",),
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    evaluate_on: str = "test",
    seed: int = 42,
    wide: Sequence[str] = (),
    output: str | None = None,
) -> Scored:
    """Fit on 70 % of the customers, score all, evaluate on the other 30 %.

    ``evaluate_on="train"`` fits and evaluates on all customers. The clean rows
    are kept while the fit and the scoring read them. ``wide`` names categories of very
    many values, which are indexed by tables.
    """
    complete = cleaning.drop_nulls(df, [*categorical, *numeric, "churn"])
    numbers = cleaning.drop_nulls(cleaning.cast_numeric(complete, numeric), numeric)
    rows = cleaning.label_from_text(numbers, "churn", LABEL)
    indices = [f"{c}_idx" for c in categorical]
    pipeline = Pipeline(
        stages=[
            *indexing.indexers(categorical, indices, wide, keys[0]),
            features.assembler([*indices, *numeric]),
            models.logistic(LABEL, 10),
        ]
    )
    with models.kept(rows) as clean:
        train = split.hash_split(clean, keys, (0.7, 0.3), seed)[0] if evaluate_on == "test" else clean
        model = models.without_summary(pipeline.fit(train))
        scored = split.with_part(model.transform(clean), keys, "part", (0.7, 0.3), seed)
        predictions = stored(models.with_class_probability(scored), "churn", output)
    evaluated = predictions.filter("part = 1") if evaluate_on == "test" else predictions
    result = classified(model, evaluated, LABEL)
    return Scored(model, predictions, result.confusion, result.report)
