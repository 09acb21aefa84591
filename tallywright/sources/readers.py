"""CSV and Parquet scans over any path Spark can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header line; quotes inside quoted text are doubled.

    A large file is divided among tasks at its line ends. Fields with line breaks need
    ``multi_line=True``: such a file is read by one task, so write many (``write_csv`` has
    ``max_records``).

    A schema saves the extra pass over the file which inference needs, and its
    names are checked against the header. Without one the types are inferred.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    # Only an empty field without quotes is a null; a quoted one is an empty text.
    reader = reader.option("nullValue", "\0null\0")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread_small_scan(df: DataFrame) -> DataFrame:
    """A scan dealt out over all cores where it has fewer partitions than these.

    For costly work on each row of a few files. A scan of many files passes
    through as it is. Only for frames read from files: asking a frame with a
    shuffle for its partitions would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
