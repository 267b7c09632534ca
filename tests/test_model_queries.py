"""The registered model queries fit the models that the operators define."""

from pyspark.sql import functions as F

from contract import queries
from ledgerlark.operators.ranking import ranking_metrics
from ledgerlark.plans.training import MODELS, Trained

SF = "/root/testdata/sf0.001"


def test_metrics_are_those_of_the_full_models(spark, monkeypatch):
    specs = []
    monkeypatch.setattr(queries, "train", lambda features, spec: specs.append(spec) or Trained(None, {"auc_roc": 0.5}))
    queries.QUERIES["train_gbt_metrics"](spark, SF)
    queries.QUERIES["train_weighted_metrics"](spark, SF)
    assert [s.trees for s in specs] == [MODELS["gbt"], MODELS["xgb"]]


def test_scores_are_those_of_the_full_model(spark, monkeypatch, tmp_path):
    fitted = []
    monkeypatch.setattr(queries, "fit", lambda rows, spec, fit=queries.fit: fitted.append(fit(rows, spec)) or fitted[-1])
    features = queries._train_features(spark, SF)
    queries.QUERIES["train_score"](spark, SF).write.parquet(f"{tmp_path}/scores")
    scores = spark.read.parquet(f"{tmp_path}/scores")
    trees = fitted[0].model.stages[-1]
    assert (trees.getNumTrees, max(t.depth for t in trees.trees)) == (120, 6)
    assert scores.count() == features.count() and scores.filter("probability between 0 and 1").count() == scores.count()
    labels = queries.prepare(features).select(queries.row_id(), "label")
    found = ranking_metrics(scores.join(labels, scores.columns[0]).withColumn("label", F.col("label").cast("double")), "probability").head()
    print("auc_roc", found.auc_roc)
    assert found.auc_roc > 0.95
