"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step, on edges (a, b)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The minima are stored: a join with an aggregate is sorted by it, and only a join of plain
    # shuffles is one whose hot keys Spark divides.
    nearest = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "nearest")
    large = both.join(nearest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    large = materialize(large.distinct(), "large_stars")
    lowest = materialize(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    moved = large.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node
    that can be reached. Loops and repeated edges are allowed, nulls are not.

    Alternating large and small stars: each step hangs neighbours on the smallest
    node known near them, until every component is one star. The number of steps
    grows with the logarithm of the longest chain. Each step is a table in the
    shared folder, so a lost executor costs no more than one step. The minimum
    per node is combined in each task before the shuffle and stored; the rows of a node
    with very many neighbours meet it in a join of two stored tables, which Spark splits.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        edges = materialize(_stars(edges), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
