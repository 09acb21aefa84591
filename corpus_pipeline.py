"""From raw documents to packed training sequences: one filter after another."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallywright.llm import lines, packing, quality, simhash
from tallywright.sources.scratch import delete_path, materialize_alone

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the base rules or the learned rules reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Long lines shared by five documents stay in one of them."""
    return lines.drop_lines(docs, min_docs=5, min_chars=40)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token pieces of the remaining documents and their places in sequences."""
    return packing.packed_documents(docs, capacity=1024)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("best_fit_packing", packed),
]
# Fingerprints need XXH64 over shingles, which SQL here cannot compute.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over documents; each is stored and read again. A stage's table and all that it
    stored on the way go once the next one is stored, so no more than two stages lie there."""
    docs, before = spark.read.parquet(f"{folder}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = materialize_alone(spark, partial(stage, spark, docs, folder), name)
        if before is not None:
            delete_path(spark, before)
        before = path
    return docs
