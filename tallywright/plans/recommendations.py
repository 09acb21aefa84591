"""Recommendation job: predicted ratings and the best products per user."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tallywright.operators import cleaning, metrics, recommend, split
from tallywright.plans.results import stored
from tallywright.sources.writers import write_csv


@dataclass(frozen=True)
class Recommendations:
    model: recommend.Recommender
    predictions: DataFrame
    comparison: DataFrame
    metrics: DataFrame
    k: int
    users: DataFrame | None

    @cached_property
    def top(self) -> DataFrame:
        """The ``k`` best products of each of the users, found when they are first asked for."""
        return recommend.top_items(self.model, self.k, self.users)


def recommendations(
    df: DataFrame,
    k: int = 3,
    rank: int = 10,
    max_iter: int = 10,
    rounded: bool = False,
    blocks: int | None = None,
    users: DataFrame | None = None,
    seed: int = 42,
    output: str | None = None,
) -> Recommendations:
    """Factors of 80 % of the ratings, evaluated on the others. The ratings are
    stored once, since training and evaluation both read them.

    The comparison table counts predictions rounded to cents; ``rounded`` makes
    the error figures use these too. ``users`` (user_id) are those to recommend to, by
    default all.
    """
    complete = stored(cleaning.drop_nulls(df.select("user_id", "product_id", "rating")), "ratings")
    train, test = split.hash_split(complete, ["user_id", "product_id"], (0.8, 0.2), seed)
    model = recommend.fit_als(recommend.als(rank=rank, max_iter=max_iter, seed=seed), train, blocks)
    scores = metrics.with_rounded(model.transform(test), "prediction", "rounded")
    predictions = stored(scores, "rating-predictions")
    if output is not None:
        write_csv(predictions, output)
    return Recommendations(
        model,
        predictions,
        metrics.confusion_matrix(
            predictions, "rating", "rounded", ("Actual_Rating", "Predicted_Rating"), "Count"
        ).orderBy("Actual_Rating", "Predicted_Rating"),
        metrics.regression_metrics(predictions, "rating", "rounded" if rounded else "prediction"),
        k,
        users,
    )
