"""Decision thresholds on a probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.numbers import as_flag

DEFAULT_THRESHOLD = 0.5
STEP = 0.01
STEPS = 100


def _step_below(p: Column, step: float, steps: int) -> Column:
    """The largest i of 0..steps with i * step <= p; -1 below the first, null for null.

    The quotient may miss a bound by one in its last bit, therefore the two
    neighbours are compared exactly as a plain comparison would.
    """
    inside = F.greatest(F.least(p, F.lit(step * (steps + 1))), F.lit(-step))
    guess = F.least(F.floor(inside / F.lit(step)), F.lit(steps)).cast("int")
    up = guess + 1
    exact_up = (up <= steps) & (up.cast("double") * F.lit(step) <= p)
    exact = guess.cast("double") * F.lit(step) <= p
    found = F.greatest(F.when(exact_up, up).when(exact, guess).otherwise(guess - 1), F.lit(-1))
    return F.when(p.isNotNull(), found)


def threshold_sweep(
    df: DataFrame, label: str, probability: str, step: float = STEP, steps: int = STEPS
) -> DataFrame:
    """Confusion counts and weighted F1 of ``probability >= t`` at every threshold.

    One pass over the rows: each falls between two thresholds, and the counts of
    these few slots, added up from the highest downwards, give the positives of
    every threshold. Rows without label or probability are left out: the first
    are not counted, and no threshold joins the empty slot of the second. A filter
    would do the same, but have the model score each row twice.
    """
    is_positive = F.col(label) == 1
    slots = df.groupBy(_step_below(F.col(probability), step, steps).alias("slot")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")
    )
    # One row per slot, 102 at most by default: safe for a broadcast and one task.
    grid = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("slot"))
    filled = grid.join(F.broadcast(slots), "slot", "left").na.fill(0, ["pos", "neg"])
    from_above = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_below = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = filled.select(
        "slot",
        F.sum("pos").over(from_above).alias("tp"),
        F.sum("neg").over(from_above).alias("fp"),
        F.coalesce(F.sum("pos").over(from_below), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(from_below), F.lit(0)).alias("tn"),
    ).filter("slot >= 0")
    return counts.select(
        F.col("slot").alias("step"),
        (F.col("slot").cast("double") * F.lit(step)).alias("threshold"),
        "tp",
        "fp",
        "fn",
        "tn",
        _weighted_f1().alias("f1"),
    )


def _weighted_f1() -> Column:
    """F1 of both classes, weighted by their rows; 0 where there are none."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def f1(hits: Column, wrong: Column, missed: Column) -> Column:
        return F.when(hits > 0, 2 * hits / (2 * hits + wrong + missed)).otherwise(F.lit(0.0))

    positives, negatives = tp + fn, tn + fp
    total = positives + negatives
    weighted = f1(tp, fp, fn) * positives + f1(tn, fn, fp) * negatives
    return F.when(total > 0, weighted / total).otherwise(F.lit(0.0))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold of the highest F1, compared to 12 digits; 0.5 with F1 0 where none is above 0."""
    best = sweep.agg(F.max(F.struct(F.round("f1", 12).alias("r"), (-F.col("step")).alias("neg_step"), "threshold", "f1")).alias("b"))
    found = F.coalesce(F.col("b.f1") > 0, F.lit(False))
    return best.select(
        F.when(found, F.col("b.threshold")).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.when(found, F.col("b.f1")).otherwise(F.lit(0.0)).alias("f1"),
    )


def apply_threshold(
    df: DataFrame, probability: str, threshold: DataFrame | float, output: str = "prediction_best"
) -> DataFrame:
    """1.0 where the probability reaches the threshold, else 0.0.

    A threshold given as a one-row frame is read as a scalar, without a join.
    """
    limit = threshold.select("threshold").scalar() if isinstance(threshold, DataFrame) else F.lit(float(threshold))
    return df.withColumn(output, as_flag(F.col(probability) >= limit))
