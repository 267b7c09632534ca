"""Exact ranking metrics of a score against a 0/1 label.

Cumulative counts over all rows need a global order. Rows are first summed up per distinct score and
kept as a table. Approximate quantiles of the distinct scores, each counted once however many rows
have it, then cut them into ranges of similar size; each range is accumulated in its own task on top
of the totals of the ranges above it. The cuts only spread the work, the result does not depend on
them. Rows without a label are left out.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import stored

MIN_RANGES = 256


def _ranges(df: DataFrame) -> int:
    """Grows with the session's shuffle width, so that a range stays a task-sized share."""
    return max(MIN_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _cut(df: DataFrame, score: str, ranges: int) -> Bucketizer:
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(df.approxQuantile(score, shares, 1 / (4 * ranges)))) or [0.0]
    bounds = [float("-inf"), *[c for c in cuts if abs(c) != float("inf")], float("inf")]
    if len(bounds) == 2:
        bounds.insert(1, 0.0)
    return Bucketizer(splits=bounds, inputCol="score", outputCol="range", handleInvalid="keep")


def ranked_groups(
    df: DataFrame, score: str, label: str = "label", ranges: int | None = None
) -> DataFrame:
    """Per distinct score: ``pos`` and ``neg`` rows with it, ``tp`` and ``fp`` with at least it.

    A missing score ranks last.
    """
    ranked_by = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    rows = df.select(ranked_by.alias("score"), F.col(label).alias("label"))
    groups = rows.where(F.col("label").isNotNull()).groupBy("score").agg(
        F.sum(F.when(F.col("label") > 0.5, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") > 0.5, 0).otherwise(1)).alias("neg"),
    )
    groups = stored(groups, "scores")
    ranged = _cut(groups, "score", ranges or _ranges(df)).transform(groups)
    totals = ranged.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    # One row per range, as many as the shuffle has tasks: one task orders them, all get them.
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
    )
    down = Window.partitionBy("range").orderBy(F.desc("score"))
    return ranged.join(F.broadcast(offsets), "range").select(
        "score",
        "pos",
        "neg",
        (F.col("p_above") + F.sum("pos").over(down)).alias("tp"),
        (F.col("n_above") + F.sum("neg").over(down)).alias("fp"),
    )


def _precision(tp: Column, fp: Column) -> Column:
    return F.try_divide(tp.cast("double"), tp + fp)


def ranking_metrics(
    df: DataFrame, score: str, label: str = "label", ranges: int | None = None
) -> DataFrame:
    """One row: ``auc_roc`` and ``auc_pr``.

    ROC: trapezoids over the false positive rate. PR: trapezoids over recall, the precision of
    the highest score carried to recall 0. NULL where a class is missing.
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    here = _precision(tp, fp)
    before = F.coalesce(_precision(tp - pos, fp - neg), here)
    groups = ranked_groups(df, score, label, ranges)
    summed = groups.agg(
        F.sum(neg * (tp - pos / 2)).alias("roc"),
        F.sum(pos * (here + before) / 2).alias("pr"),
        F.sum(pos).alias("positives"),
        F.sum(neg).alias("negatives"),
    )
    return summed.select(
        F.try_divide("roc", F.col("positives") * F.col("negatives")).alias("auc_roc"),
        F.try_divide("pr", "positives").alias("auc_pr"),
    )
