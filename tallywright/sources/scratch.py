"""Intermediate tables in the folder which all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Paths made since the innermost ``scratch_tables`` began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes, when it ends, the scratch tables made inside. For a job that has written
    its results by then; a frame that is still to be read needs its tables."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, through the file system that its address names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> tuple[DataFrame, str]:
    """What ``make`` returns as a stored table, and its path. The scratch tables that were made on
    the way are deleted once it is stored."""
    path = scratch_path(spark, name)
    with scratch_tables(spark):
        made = make()
        schema = made.schema
        made.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Without that setting it is the checkpoint folder of the running context.
    Only a local session that has neither gets a folder of its own: on a cluster
    a folder of one machine would lose data with that machine.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder which all executors can reach")
    own = tempfile.mkdtemp(prefix="tallywright-")
    context.setCheckpointDir(own)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder where it has none yet."""
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call uses."""
    path = f"{scratch_root(spark)}/tallywright/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read it back.

    Cuts the lineage at a point that outlives any executor, and gives the
    optimizer the true size of the result.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
