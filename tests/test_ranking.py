import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlark.operators.ranking import ranking_metrics

SCHEMA = "score double, label double"


def metrics(df, **how):
    row = ranking_metrics(df, "score", **how).head()
    return row["auc_roc"], row["auc_pr"]


@pytest.mark.parametrize("ranges", [2, 7, 64])
@pytest.mark.parametrize("distinct", [1, 5, 100000])
def test_equals_the_evaluator(spark, ranges, distinct):
    draw = random.Random(distinct)
    rows = []
    for _ in range(2000):
        label = float(draw.random() < 0.1)
        rows.append((float(draw.randrange(distinct)) + label * distinct / 10, label))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name, value in zip(("areaUnderROC", "areaUnderPR"), metrics(df, ranges=ranges)):
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", metricName=name, numBins=0
        )
        assert value == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_a_score_shared_by_a_third_of_the_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 3000).alias("score"),
        (F.col("id") % 7 == 0).cast("double").alias("label"),
    )
    assert metrics(df, ranges=16) == pytest.approx(metrics(df, ranges=2))


def test_perfect_reversed_and_missing_classes(spark):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert metrics(frame([(0.9, 1.0), (0.1, 0.0)])) == (1.0, 1.0)
    assert metrics(frame([(0.1, 1.0), (0.9, 0.0)]))[0] == 0.0
    assert metrics(frame([(0.1, 1.0), (0.9, 1.0)]))[0] is None
    assert metrics(frame([(0.1, 0.0)])) == (None, None)
    assert metrics(frame([])) == (None, None)


def test_missing_scores_rank_last(spark):
    df = spark.createDataFrame([(None, 0.0), (0.1, 1.0), (0.0, 0.0)], SCHEMA)
    assert metrics(df)[0] == 1.0
