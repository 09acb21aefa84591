"""Sentiment job: words, hashed counts, idf and multinomial regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame

from tallywright.operators import cleaning, indexing, metrics, models, split, text, tuning
from tallywright.plans.results import Scored, stored
from tallywright.sources.writers import write_csv


@dataclass(frozen=True)
class Sentiment:
    scored: Scored
    grid: DataFrame | None
    search: tuning.GridSearch | None


def sentiment_model(
    df: DataFrame,
    keys: Sequence[str] = ("post_id",),
    buckets: Sequence[int] = (1000, 2000),
    regs: Sequence[float] = (0.01, 0.1),
    max_iter: int = 20,
    tune: bool = True,
    folds: int = 3,
    parallelism: int = 4,
    seed: int = 42,
    partitions: int | None = None,
    output: str | None = None,
) -> Sentiment:
    """Sentiment of posts. Untuned, the last of ``buckets`` and no penalty apply.

    Splitting the text needs no fit, so it is done once, ahead of the search,
    and not again in each of its fits. Labels are indexed by the training rows;
    a sentiment only the test rows have counts as missed.
    """
    posts = cleaning.drop_nulls(df, [*keys, "post_text", "sentiment"])
    words = stored(text.ml_words(posts, "post_text", "filtered_words"), "post-words")
    train, test = split.hash_split(words, keys, (0.8, 0.2), seed)
    labels = indexing.string_indexer(["sentiment"], ["label"], "error").fit(train)
    train = labels.transform(train).select(*keys, "filtered_words", "label")
    counts = text.hashing_tf("filtered_words", "raw_features", buckets[-1])
    regression = models.logistic("label", max_iter)
    stages = [counts, text.idf("raw_features", "features"), regression]
    search = None
    if tune:
        points = (
            ParamGridBuilder()
            .addGrid(counts.numFeatures, list(buckets))
            .addGrid(regression.regParam, list(regs))
            .build()
        )
        search = tuning.grid_search(
            train, keys, stages, points, "label", tuning.weighted_f1, folds, parallelism, seed, partitions
        )
        model: Model = search.best
    else:
        model = models.fit(Pipeline(stages=stages), train, ["filtered_words", "label"], keys, partitions)
    labels.setHandleInvalid("keep")
    scored = indexing.index_to_label(
        model.transform(labels.transform(test)), "prediction", labels.labels, "predicted_label"
    )
    predictions = stored(scored.drop("raw_features", "features", "filtered_words"), "sentiment")
    if output is not None:
        write_csv(predictions.select(*keys, "post_text", "sentiment", "predicted_label"), output)
    result = Scored(
        model,
        predictions,
        metrics.confusion_matrix(
            predictions, "sentiment", "predicted_label", ("Actual", "Predicted"), "Count"
        ).orderBy("Actual", "Predicted"),
        metrics.classification_report(predictions, "label", "prediction"),
    )
    return Sentiment(result, search.scores() if search else None, search)
