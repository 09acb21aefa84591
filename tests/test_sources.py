from __future__ import annotations

import glob
import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tallywright.operators import models
from tallywright.sources import readers, scratch, writers


def test_csv_schema_and_inference_agree(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,name,x\n1,"a, b",1.5\n2,,\n')
    schema = StructType(
        [StructField("id", IntegerType()), StructField("name", StringType()), StructField("x", DoubleType())]
    )
    declared = readers.read_csv(spark, str(tmp_path / "in.csv"), schema)
    inferred = readers.read_csv(spark, str(tmp_path / "in.csv"))
    assert inferred.schema == declared.schema
    assert declared.collect() == inferred.collect() == [(1, "a, b", 1.5), (2, None, None)]


def test_csv_leaves_out_vectors(spark, tmp_path):
    df = spark.createDataFrame([(1, Vectors.dense([1.0]), [1])], ["id", "v", "a"])
    writers.write_csv(df, str(tmp_path / "out"))
    assert readers.read_csv(spark, str(tmp_path / "out")).columns == ["id"]


def test_single_file(spark, tmp_path):
    df = spark.range(100).repartition(5)
    writers.write_csv(df, str(tmp_path / "many"))
    writers.write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(glob.glob(str(tmp_path / "many" / "*.csv"))) > 1
    assert len(glob.glob(str(tmp_path / "one" / "*.csv"))) == 1
    assert readers.read_csv(spark, str(tmp_path / "one")).count() == 100


def test_writes_replace(spark, tmp_path):
    for n in (5, 3):
        writers.write_parquet(spark.range(n), str(tmp_path / "p"))
        writers.write_csv(spark.range(n), str(tmp_path / "c"))
    assert readers.read_parquet(spark, str(tmp_path / "p")).count() == 3
    assert readers.read_csv(spark, str(tmp_path / "c")).count() == 3


def test_vectors_as_arrays(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(3, [1], [2.0]))], ["id", "v"])
    assert writers.vectors_as_arrays(df).first()["v"] == [0.0, 2.0, 0.0]


def test_materialized_rows_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == root
    stored = scratch.materialize(spark.range(10), "ten")
    assert stored.count() == 10
    assert all(root in f for f in stored.inputFiles())


def test_kept_rows_are_released(spark):
    df = spark.range(10)
    with models.kept(df) as rows:
        assert rows.is_cached
    assert not df.is_cached
    with pytest.raises(RuntimeError), models.kept(df):
        raise RuntimeError
    assert not df.is_cached


def test_training_rows_lie_the_same_in_any_layout(spark):
    def layout(df):
        with models.training_rows(df, ["id"], 6) as rows:
            assert rows.rdd.getNumPartitions() == 6
            return rows.rdd.glom().collect()

    df = spark.range(3000)
    assert layout(df.coalesce(1)) == layout(df.repartition(4)) == layout(df.repartition(7))


def test_texts_survive_csv(spark, tmp_path):
    texts = ["plain", "two\nlines", 'a "quoted" one', "crlf\r\nend\r", "", None, "  spaces  ", "a,b;c\\", '"', "\\", "\\\"", "é😀", "x" * 100_000, "tab\t", ",", "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    writers.write_csv(df, str(tmp_path / "c"), max_records=3)
    back = {r["id"]: r["text"] for r in readers.read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=True).collect()}
    assert back == dict(enumerate(texts))


def test_scratch_tables_go_when_the_job_ends(spark):
    with scratch.scratch_tables(spark):
        path = scratch.scratch_path(spark, "kept")
        spark.range(3).write.parquet(path)
        inner = scratch.materialize(spark.range(4), "inner")
        assert inner.count() == 4 and os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
    outside = scratch.materialize(spark.range(4), "outside")
    assert outside.count() == 4


def test_small_scans_are_dealt_out(spark, tmp_path):
    writers.write_parquet(spark.range(100).coalesce(1), str(tmp_path / "p"))
    df = readers.spread_small_scan(spark.read.parquet(str(tmp_path / "p")))
    assert df.rdd.getNumPartitions() == 8
    assert df.count() == 100
