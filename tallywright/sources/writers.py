"""Sinks. Every write replaces what the path held before, once it is complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def replace(df: DataFrame, path: str, write: Callable[[str], None]) -> None:
    """Write beside ``path``, then put the new folder in the place of the old one.

    A write that fails leaves what there was, and a frame may replace the folder it is read
    from. Readers find the path missing only between two renames; where a file system
    renames by copying, that takes as long as the copy. Should the second rename fail, the old
    folder is put back. The folder beside has a name that Spark's readers of the parent pass over.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    parent, _, name = path.rpartition("/")
    mark = uuid.uuid4().hex
    new, old = (f"{parent}/_{name}.{kind}-{mark}" if parent else f"_{name}.{kind}-{mark}" for kind in ("new", "old"))
    place, beside, aside = (hadoop.Path(p) for p in (path, new, old))
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(new)
    except BaseException:
        files.delete(beside, True)
        raise
    held = files.exists(place)
    if held and not files.rename(place, aside):
        files.delete(beside, True)
        raise OSError(f"{path} cannot be renamed")
    if not files.rename(beside, place):
        if held:
            files.rename(aside, place)
        raise OSError(f"{new} cannot be renamed to {path}")
    if held:
        files.delete(aside, True)


def write_parquet(df: DataFrame, path: str) -> None:
    replace(df, path, lambda new: df.write.mode("overwrite").parquet(new))


def flat_columns(df: DataFrame) -> DataFrame:
    """Only the columns a CSV file can hold: no vectors, arrays, maps or structs."""
    nested = (VectorUDT, ArrayType, MapType, StructType)
    return df.select(*[f.name for f in df.schema.fields if not isinstance(f.dataType, nested)])


def write_csv(df: DataFrame, path: str, single_file: bool = False, max_records: int = 1_000_000) -> None:
    """CSV with a header, in files of at most ``max_records`` rows. Any text comes back as it
    was: line breaks and commas are quoted, quotes doubled, outer spaces kept.
    ``single_file`` is for small reports only.

    The one-file form shuffles the finished rows to the writing task, so the
    work before it keeps its parallelism.
    """
    flat = flat_columns(df)
    if single_file:
        flat = flat.repartition(1)
    writer = flat.write.mode("overwrite").option("header", True).option("escape", '"')
    if not single_file:
        writer = writer.option("maxRecordsPerFile", max_records)
    exact = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    replace(df, path, exact.csv)


def vectors_as_arrays(df: DataFrame) -> DataFrame:
    """Vector columns as arrays of doubles, for readers without the ML types."""
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    return df.withColumns({name: vector_to_array(F.col(name)) for name in vectors}) if vectors else df
