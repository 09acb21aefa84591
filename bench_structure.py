"""Cost of the one-pass operators beside the job-per-figure way to the same
result, on the data of bench.py. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession

from tallywright.operators import balance, indexing, metrics, thresholds
from tallywright.plans import tables

METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")


def evaluate(df: DataFrame, prediction: str, metric: str) -> float:
    return MulticlassClassificationEvaluator(
        labelCol="is_fraud", predictionCol=prediction, metricName=metric
    ).evaluate(df)


def sweep_by_jobs(df: DataFrame) -> float:
    best = (0.0, 0.5)
    for i in range(101):
        applied = thresholds.apply_threshold(df, "probability_1", i * 0.01, "p")
        best = max(best, (evaluate(applied, "p", "f1"), -i * 0.01))
    return -best[1]


def index_by_fits(df: DataFrame, columns: tuple[str, ...]) -> None:
    for c in columns:
        df = StringIndexer(inputCol=c, outputCol=c + "_i", handleInvalid="keep").fit(df).transform(df)


def counts_by_jobs(df: DataFrame) -> tuple[int, int, int]:
    return df.count(), df.filter("is_fraud = 1").count(), df.filter("is_fraud = 0").count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scored, people = tables.scored(spark, folder), tables.customers(spark, folder)
    columns = tables.CHURN_CATEGORICAL
    pairs = {
        "threshold_sweep": (
            lambda: thresholds.best_threshold(
                thresholds.threshold_sweep(scored, "is_fraud", "probability_1")
            ).first()["threshold"],
            lambda: sweep_by_jobs(scored),
        ),
        "four_metrics": (
            lambda: metrics.classification_report(scored, "is_fraud", "prediction").first(),
            lambda: [evaluate(scored, "prediction", m) for m in METRICS],
        ),
        "index_seven_columns": (
            lambda: indexing.index_columns(people, columns, handle_invalid="keep"),
            lambda: index_by_fits(people, columns),
        ),
        "three_counts": (
            lambda: balance.class_counts(scored, "is_fraud").collect(),
            lambda: counts_by_jobs(scored),
        ),
    }
    out = {}
    for name, (one_pass, by_jobs) in pairs.items():
        one_pass()
        start = time.perf_counter()
        first = one_pass()
        middle = time.perf_counter()
        second = by_jobs()
        end = time.perf_counter()
        out[name] = {"one_pass": round(middle - start, 2), "job_per_figure": round(end - middle, 2)}
        print(name, out[name], first if name == "threshold_sweep" else "", second, file=sys.stderr, flush=True)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
