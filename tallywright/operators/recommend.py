"""Recommendations by alternating least squares."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators.lookup import attach_lookup
from tallywright.operators.models import partitions_for, placed_rows
from tallywright.operators.ranking import numbered, value_numbers
from tallywright.sources.scratch import ensure_checkpoint_dir, materialize

# Blocks of users and of items at least, and ratings of one at most. Starting factors follow from
# the number, which grows with the ratings so that one block fits into a task's memory. A factor is
# sent to each block that has a rating of it in every iteration, so blocks are as few as that allows.
BLOCKS = 10
RATINGS_PER_BLOCK = 1 << 25
# Items and users scored at a time, and bytes of item factors that are broadcast at a time.
BLOCK_ITEMS = 512
BLOCK_USERS = 2048
BROADCAST_BYTES = 1 << 26


def als(
    user: str = "user_id",
    item: str = "product_id",
    rating: str = "rating",
    rank: int = 10,
    max_iter: int = 10,
    reg: float = 0.1,
    seed: int = 42,
) -> ALS:
    """Explicit ratings, factors not below zero. Users and items that were not
    trained on get no prediction: their rows are dropped.

    Blocks and factors lie on disk between the steps: a block takes some 44 bytes a rating of a
    task's memory while it is made, which Spark's memory manager does not count, so the
    memory is left to that.
    """
    return ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        maxIter=max_iter,
        regParam=reg,
        nonnegative=True,
        coldStartStrategy="drop",
        seed=seed,
        checkpointInterval=5,
        intermediateStorageLevel="DISK_ONLY",
        finalStorageLevel="DISK_ONLY",
    )


def blocks_for(ratings: int) -> int:
    """Blocks of users and of items for so many ratings."""
    return partitions_for(ratings, BLOCKS, RATINGS_PER_BLOCK)


@dataclass(frozen=True)
class Recommender:
    """Factors, and the numbers by which users and items of any type are known to them."""

    model: ALSModel
    user: str
    item: str
    users: DataFrame
    items: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a prediction; rows of users or items that are not known are dropped."""
        for mapping, on, spread in ((self.users, self.user, self.item), (self.items, self.item, self.user)):
            df = attach_lookup(df, mapping, on, "n_rows", spread).drop("n_rows")
        return self.model.transform(df).drop("_user", "_item")


def fit_als(estimator: ALS, train: DataFrame, blocks: int | None = None) -> Recommender:
    """Fit on the three columns needed.

    Users and items may be of any type and value: they are numbered first. Ratings are
    placed by user and item, so the factors depend on the number of blocks, which follows
    from that of the ratings unless given, but not on cores or files. Every fifth iteration
    goes to the shared folder, which keeps the lineage of the factors short. The placed ratings
    are read once, by the step that makes blocks of them, so they are not kept.
    """
    ensure_checkpoint_dir(train.sparkSession)
    user, item, rating = estimator.getUserCol(), estimator.getItemCol(), estimator.getRatingCol()
    ratings = materialize(train.select(user, item, rating), "train-ratings")

    partitions = blocks
    if blocks is None:
        count = ratings.count()
        blocks, partitions = blocks_for(count), partitions_for(count, BLOCKS)

    def numbers(column: str, output: str) -> DataFrame:
        return value_numbers(ratings, column, output).withColumn(output, F.col(output).cast("int"))

    users, items = numbers(user, "_user"), numbers(item, "_item")
    rows = attach_lookup(attach_lookup(ratings, users, user, "n_rows", item).drop("n_rows"), items, item, "n_rows", user)
    placed = placed_rows(rows.select("_user", "_item", rating), ["_user", "_item", rating], partitions or partitions_for(ratings.count()))
    model = estimator.copy().setUserCol("_user").setItemCol("_item").setNumBlocks(blocks).fit(placed)
    return Recommender(model, user, item, users, items)


class _Best:
    """The ``k`` best (score, item) so far of each of some rows, equal scores by item."""

    def __init__(self, rows: int, k: int, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        self.k, self.rows = k, rows
        self.row, self.item, self.score = row, item, score
        self._cut()

    def _cut(self) -> None:
        order = np.lexsort((self.item, -self.score, self.row))
        row = self.row[order]
        first = np.searchsorted(row, np.arange(self.rows + 1))
        order = order[np.arange(len(row)) - first[row] < self.k]
        self.row, self.item, self.score = self.row[order], self.item[order], self.score[order]
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))
        full = np.diff(self.first) == self.k
        self.least = np.full(self.rows, -np.inf, np.float32)  # the score to reach, once there are k
        self.least[full] = self.score[self.first[1:][full] - 1]

    def add(self, row: np.ndarray, items: np.ndarray, scores: np.ndarray) -> None:
        """Scores of the given rows (ascending) for all of ``items``."""
        least = self.least[row]
        if len(items) > self.k:
            least = np.maximum(least, np.partition(scores, len(items) - self.k, axis=1)[:, len(items) - self.k])
        at, which = np.nonzero(scores >= least[:, None])
        self.row = np.concatenate((self.row, row[at]))
        self.item = np.concatenate((self.item, items[which]))
        self.score = np.concatenate((self.score, scores[at, which]))
        self._cut()


def top_scores(
    users: DataFrame, items: DataFrame, k: int, block_items: int = BLOCK_ITEMS, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(id, best, n_scored) for factors (id, features) of users and items: the ``k`` items of
    the highest inner products as array<struct<item, rating>>, and how many were scored.

    Items are taken from the longest factor, a block at a time. The product is no more than
    length times length, so a user's scan ends at the block whose longest factor cannot reach
    the user's k-th score; the result is exact. Of equal scores the smaller item is better.
    Item factors are broadcast, ``broadcast_bytes`` at a time; only users whose scan has not
    ended go on to the next round.
    """
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    ordered = numbered(items.select("id", "features", length.alias("length")), [F.desc("length"), F.asc("id")], "place")
    count = ordered.count()
    rank = ordered.agg(F.max(F.size("features"))).first()[0] or 1
    per_round = max(block_items, broadcast_bytes // (8 * (rank + 2)))
    schema = "id int, features array<float>, ended boolean, n_scored long, best array<struct<item: int, rating: float>>"
    none = F.array().cast("array<struct<item: int, rating: float>>")
    state = users.select("id", "features", F.lit(False).alias("ended"), F.lit(0).cast("long").alias("n_scored"), none.alias("best"))
    context, finished = users.sparkSession.sparkContext, []
    for first in range(0, max(count, 1), per_round):
        some = ordered.filter((F.col("place") >= first) & (F.col("place") < first + per_round)).toArrow().sort_by("place")
        factors = np.array(some.column("features").to_pylist(), np.float64).reshape(len(some), rank)
        shared = context.broadcast((some.column("id").to_numpy(), factors, some.column("length").to_numpy()))
        last = first + per_round >= count

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            ids, factors, lengths = shared.value
            for batch in (b.slice(i, BLOCK_USERS) for b in batches for i in range(0, b.num_rows, BLOCK_USERS)):
                rows = batch.num_rows
                own = np.array(batch.column("features").to_pylist(), np.float64).reshape(rows, -1)
                before = batch.column("best")
                entries = before.flatten()
                best = _Best(
                    rows, k, np.repeat(np.arange(rows), np.diff(before.offsets.to_numpy())),
                    entries.field("item").to_numpy(zero_copy_only=False), entries.field("rating").to_numpy(zero_copy_only=False),
                )
                most = np.sqrt((own * own).sum(axis=1)) * (1 + 1e-6)  # scores are rounded to floats
                scored = batch.column("n_scored").to_numpy().copy()
                open_ = np.arange(rows)
                for start in range(0, len(ids), block_items):
                    open_ = open_[most[open_] * lengths[start] >= best.least[open_]]
                    if not len(open_):
                        break
                    block = slice(start, start + block_items)
                    best.add(open_, ids[block], (own[open_] @ factors[block].T).astype(np.float32))
                    scored[open_] += len(ids[block])
                ended = np.ones(rows, bool)
                ended[open_] = last
                pairs = pa.StructArray.from_arrays([pa.array(best.item, pa.int32()), pa.array(best.score, pa.float32())], ["item", "rating"])
                found = pa.ListArray.from_arrays(pa.array(best.first, pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("features"), pa.array(ended), pa.array(scored), found],
                    ["id", "features", "ended", "n_scored", "best"],
                )

        state = materialize(state.mapInArrow(scan, schema), "best-items")
        shared.destroy()
        finished.append(state.filter("ended"))
        state = state.filter("not ended")
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result.select("id", "best", "n_scored")


def top_items(recommender: Recommender, k: int = 3, users: DataFrame | None = None) -> DataFrame:
    """The ``k`` best items as an array ordered by score: of every user, or of those in the
    user column of ``users`` who are known."""
    user, item, model = recommender.user, recommender.item, recommender.model
    wanted = model.userFactors
    if users is not None:
        known = users.select(user).distinct().join(recommender.users, user).select(F.col("_user").alias("id"))
        wanted = wanted.join(known, "id", "left_semi")
    found = top_scores(wanted, model.itemFactors, k).select(F.col("id").alias("_user"), "best")
    each = found.select("_user", F.posexplode("best").alias("_place", "_best")).select(
        "_user", "_place", F.col("_best.item").alias("_item"), F.col("_best.rating").alias("rating")
    )
    named = each.join(recommender.items.select("_item", item), "_item")
    ordered = F.sort_array(F.collect_list(F.struct("_place", item, "rating")))
    best = F.transform(ordered, lambda x: F.struct(x[item].alias(item), x["rating"].alias("rating")))
    listed = named.groupBy("_user").agg(best.alias("recommendations"))
    return listed.join(recommender.users.select("_user", user), "_user").select(user, "recommendations")


def with_factors(df: DataFrame, recommender: Recommender) -> DataFrame:
    """``df`` with ``_user_factors`` and ``_item_factors``: those of each row's user and item,
    rows of others being dropped. The factors join as tables, by user and by item."""
    sides = (
        (recommender.users, recommender.user, "_user", recommender.model.userFactors, recommender.item),
        (recommender.items, recommender.item, "_item", recommender.model.itemFactors, recommender.user),
    )
    for mapping, on, number, factors, spread in sides:
        own = factors.select(F.col("id").alias(number), F.col("features").alias(f"{number}_factors"))
        known = materialize(mapping.join(own, number).select(on, "n_rows", f"{number}_factors"), "known-factors")
        df = attach_lookup(df, known, on, "n_rows", spread).drop("n_rows")
    return df


def flat_recommendations(recommendations: DataFrame, user: str = "user_id") -> DataFrame:
    """One row per user and place, place 1 being the best."""
    placed = F.posexplode("recommendations").alias("_at", "_item")
    return recommendations.select(user, placed).select(user, (F.col("_at") + 1).alias("place"), "_item.*")
