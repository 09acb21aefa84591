"""Rows of each stage of a job, counted while its result is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageCounts:
    """Counts that come with the write of a job's result, without a scan of their own.

    ``mark`` lets a frame pass and counts its rows on the way. The counts are there once an
    action on the result has ended; asking earlier waits for it. A later action counts
    nothing again. A mark keeps filters above it from moving below it, so that it
    counts the rows of its own stage.

    In a session that has counted so, fit binary classifiers of ``pyspark.ml`` through
    ``models.fit`` or ``models.without_summary``, else they cannot score.
    """

    def __init__(self) -> None:
        self._marks: dict[str, tuple[Observation, list[str]]] = {}

    def mark(self, df: DataFrame, stage: str, **parts: Column) -> DataFrame:
        """``df`` as it is; its rows count as ``stage``, those that meet a condition of
        ``parts`` as the stage of that name. A condition that is null is not met."""
        seen = Observation()
        names = [stage, *parts]
        for name in names:
            if name in self._marks:
                raise ValueError(f"there is a stage {name} already")
            self._marks[name] = (seen, names)
        counts = [F.count(F.lit(1)).alias(stage), *[F.count_if(c).alias(n) for n, c in parts.items()]]
        return df.observe(seen, *counts)

    def counts(self) -> dict[str, int]:
        return {name: seen.get[name] for name, (seen, _) in self._marks.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        """(stage, n_rows) in the order of the marks."""
        return spark.createDataFrame(list(self.counts().items()), "stage string, n_rows long")


def marked(df: DataFrame, counts: StageCounts | None, stage: str, **parts: Column) -> DataFrame:
    """``df`` marked in ``counts``, where counts are wanted."""
    return df if counts is None else counts.mark(df, stage, **parts)
