"""Run one job from files: python -m tallywright JOB --input CSV --output FOLDER.

Works under spark-submit as well; master, memory and storage credentials come
from there. The figures of the job are written as JSON beside its rows.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywright.operators import recommend
from tallywright.operators.counting import StageCounts
from tallywright.plans import churn, disease, fraud, recommendations, sales, sentiment
from tallywright.plans.results import stored
from tallywright.sources import schemas
from tallywright.sources.readers import read_csv
from tallywright.sources.scratch import scratch_tables

Figures = dict[str, DataFrame]
Job = Callable[[DataFrame, str, int | None], Figures]


def clean_sales(df: DataFrame, output: str, partitions: int | None) -> Figures:
    counts = StageCounts()
    sales.clean_raw_sales(df, output=f"{output}/rows", counts=counts)
    return {"counts": counts.frame(df.sparkSession)}


def sales_report(df: DataFrame, output: str, partitions: int | None) -> Figures:
    counts = StageCounts()
    clean = stored(sales.clean_sales(df, counts=counts), "clean-sales")
    report = sales.sales_report(clean, output)
    price = sales.price_model(clean, ["order_id"], partitions=partitions, output=f"{output}/price_predictions")
    return {
        "counts": counts.frame(df.sparkSession),
        "repeat_rate": report.repeat_rate,
        "top_category": report.top_category,
        "price_errors": price.metrics,
    }


def _logistic(threshold: float | None) -> Job:
    def run(df: DataFrame, output: str, partitions: int | None) -> Figures:
        rows = f"{output}/rows"
        result = fraud.fraud_logistic(df, ["transaction_id"], threshold=threshold, partitions=partitions, output=rows)
        return {"confusion": result.confusion, "report": result.report}

    return run


def _forest(depth: int) -> Job:
    def run(df: DataFrame, output: str, partitions: int | None) -> Figures:
        counts, rows = StageCounts(), f"{output}/rows"
        result = fraud.fraud_forest(
            df, ["transaction_id"], depth=depth, partitions=partitions, output=rows, counts=counts
        )
        return {
            "counts": counts.frame(df.sparkSession),
            "sweep": result.sweep,
            "best": result.best,
            "confusion": result.confusion,
            "report": result.report,
            "recall": result.recall,
        }

    return run


def churn_job(df: DataFrame, output: str, partitions: int | None) -> Figures:
    result = churn.churn_model(df, output=f"{output}/rows")
    return {"confusion": result.confusion, "report": result.report}


def recommend_job(df: DataFrame, output: str, partitions: int | None) -> Figures:
    result = recommendations.recommendations(df, blocks=partitions, output=f"{output}/rows")
    return {
        "comparison": result.comparison,
        "errors": result.metrics,
        "top": recommend.flat_recommendations(result.top),
    }


def disease_job(df: DataFrame, output: str, partitions: int | None) -> Figures:
    result = disease.disease_model(df, partitions=partitions, output=f"{output}/rows")
    return {
        "grid": result.grid,
        "per_class": result.per_class,
        "confusion": result.scored.confusion,
        "report": result.scored.report,
    }


def sentiment_job(df: DataFrame, output: str, partitions: int | None) -> Figures:
    result = sentiment.sentiment_model(df, partitions=partitions, output=f"{output}/rows")
    return {"grid": result.grid, "confusion": result.scored.confusion, "report": result.scored.report}


JOBS: dict[str, tuple[str, Job]] = {
    "clean-sales": (schemas.SALES_RAW, clean_sales),
    "sales-report": (schemas.SALES, sales_report),
    "fraud-logistic": (schemas.TRANSACTIONS, _logistic(None)),
    "fraud-logistic-04": (schemas.TRANSACTIONS, _logistic(0.4)),
    "fraud-forest": (schemas.TRANSACTIONS, _forest(5)),
    "fraud-forest-deep": (schemas.TRANSACTIONS, _forest(8)),
    "churn": (schemas.CUSTOMERS, churn_job),
    "recommendations": (schemas.RATINGS, recommend_job),
    "disease": (schemas.PATIENTS, disease_job),
    "sentiment": (schemas.POSTS, sentiment_job),
}


def run(
    spark: SparkSession,
    job: str,
    source: str,
    output: str,
    infer: bool = False,
    multi_line: bool = False,
    partitions: int | None = None,
) -> None:
    schema, function = JOBS[job]
    with scratch_tables(spark):
        figures = function(read_csv(spark, source, None if infer else schema, multi_line), output, partitions)
        for name, figure in figures.items():
            figure.write.mode("overwrite").json(f"{output}/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallywright", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--input", required=True, help="CSV file or folder, with a header")
    parser.add_argument("--output", required=True, help="folder of the results, which are replaced")
    parser.add_argument("--infer", action="store_true", help="infer the types instead of using the known schema")
    parser.add_argument("--multi-line", action="store_true", help="fields may hold line breaks; a file is then read by one task")
    parser.add_argument("--partitions", type=int, help="partitions of the rows of a fit, by default by their number")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"tallywright-{args.job}").getOrCreate()
    run(spark, args.job, args.input, args.output, args.infer, args.multi_line, args.partitions)
    spark.stop()


if __name__ == "__main__":
    main()
