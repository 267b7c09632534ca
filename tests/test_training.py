import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlark.operators import boosting, encode
from ledgerlark.operators.balance import class_balance, positive_weight, with_label
from ledgerlark.operators.split import split, split_hash, split_time
from ledgerlark.plans import training
from ledgerlark.plans.training import TrainSpec, fit, prepare, score, train
from ledgerlark.sinks.runs import compare_runs, default_run_name, load_model, log_run, save_model


@pytest.fixture(scope="module")
def features(spark):
    """2000 rows; fraud goes with large amounts at one merchant; some values missing."""
    i = F.col("id")
    amount = (i * 7919 % 10007).cast("double")
    merchant = F.element_at(F.array(*[F.lit(m) for m in "abcde"]), (i % 5 + 1).cast("int"))
    return spark.range(2000).select(
        i.cast("string").alias("transaction_id"),
        (i % 90 + 1000).cast("int").alias("user_id"),
        F.when(i % 31 != 0, amount).alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(i % 37 != 0, merchant).alias("merchant"),
        (F.lit(1704067200) + i * 60).cast("timestamp").alias("event_ts"),
        ((amount > 7000) & (i % 5 == 0) | (i % 97 == 0)).cast("int").alias("is_fraud"),
    )


QUICK = TrainSpec().with_trees(max_iter=4, max_depth=3)


def test_weight_of_positives(spark):
    def weight(*labels):
        return positive_weight(spark.createDataFrame([(x,) for x in labels], "label double"))

    assert weight() == 1.0
    assert weight(0.0, 0.0) == 1.0
    assert weight(1.0, 1.0) == 1.0
    assert weight(1.0, *[0.0] * 9) == 9.0
    assert weight(None, 1.0, 0.0, 0.0) == 2.0
    empty = class_balance(spark.createDataFrame([], "label double")).head()
    assert (empty["pos"], empty["neg"]) == (0.0, 0.0)


def test_label_needs_a_value(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "is_fraud int")
    assert [r["label"] for r in with_label(df).collect()] == [1.0, 0.0]


def test_numeric_features_once_and_by_type(spark, features):
    extra = features.withColumn("gap", F.expr("interval 1 day"))
    assert encode.numeric_features(prepare(extra)) == ["user_id", "amount", "event_ts_unix"]


def test_splits(spark, features):
    parts = split_hash(features)
    counts = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(counts.values()) == 2000 and 1500 < counts["train"] < 1700
    again = split_hash(features.repartition(7))
    assert parts.exceptAll(again).count() == 0
    late = split_time(features).groupBy("part").agg(F.min("event_ts"), F.max("event_ts"))
    bounds = {r[0]: (r[1], r[2]) for r in late.collect()}
    assert bounds["train"][1] < bounds["test"][0]
    for how in ("hash", "time", "random"):
        a, b = split(features, how, 0.8, 1)
        assert a.count() + b.count() == 2000
    with pytest.raises(ValueError):
        split(features, "by mood", 0.8, 1)


def test_index_equals_the_frequency_order_of_the_indexer(spark, features):
    rows = features.withColumn("place", F.concat(F.lit("p"), (F.col("amount") % 700).cast("int")))
    columns = ["merchant", "place", "currency"]
    ours = encode.category_indexer(rows, columns).transform(rows)
    names = [f"{c}_idx" for c in columns]
    theirs = StringIndexer(inputCols=columns, outputCols=names, handleInvalid="keep")
    theirs = theirs.fit(rows).transform(rows)
    assert ours.select(names).exceptAll(theirs.select(names)).count() == 0


def test_values_beyond_the_limit_share_the_slot_of_unseen_ones(spark, features):
    model = encode.category_indexer(features, ["merchant"], max_categories=2)
    unseen = features.withColumn("merchant", F.lit("new"))
    indexed = model.transform(features.union(unseen))
    found = {r[0]: r[1] for r in indexed.select("merchant", "merchant_idx").distinct().collect()}
    assert sorted(found.values()) == [0.0, 1.0, 2.0, 2.0, 2.0, 2.0, 2.0]
    assert found["new"] == found[None] == 2.0
    hot = encode.one_hot(["merchant"]).fit(indexed).transform(indexed)
    slots = hot.where("merchant = 'new'").select(vector_to_array("merchant_ohe")).head()[0]
    assert slots == [0.0, 0.0, 1.0]


def test_training_learns_and_takes_missing_values(spark, features):
    trained = train(features, QUICK)
    assert trained.metrics["auc_roc"] > 0.85 and trained.metrics["auc_pr"] > 0.5
    assert trained.params["num_features"] == 5
    assert trained.params["max_iter"] == 4


def test_metrics_equal_the_evaluator(spark, features):
    rows = prepare(features)
    model = fit(rows, QUICK).model
    scored = model.transform(rows)
    for ours, theirs in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
        wanted = BinaryClassificationEvaluator(metricName=theirs, numBins=0).evaluate(scored)
        assert training.evaluate(model, rows)[ours] == pytest.approx(wanted, abs=1e-9)


def test_weighted_model(spark, features):
    spec = TrainSpec(model="XGB").with_trees(max_iter=3, max_depth=3)
    trained = train(features, spec)
    assert trained.params["scale_pos_weight"] > 5
    assert trained.metrics["auc_roc"] > 0.8


def test_default_parameters():
    gbt, weighted = TrainSpec().trees, TrainSpec(model="xgb").trees
    assert (gbt.max_iter, gbt.max_depth, gbt.step_size, gbt.subsampling_rate) == (120, 6, 0.1, 0.8)
    assert (weighted.max_iter, weighted.max_depth, weighted.step_size) == (400, 6, 0.08)
    assert weighted.l2 == 1.0 and gbt.l2 is None
    assert weighted.weighted and weighted.features == "0.8" and not gbt.weighted


def test_unknown_model_is_refused_before_any_work():
    with pytest.raises(ValueError):
        TrainSpec(model="oracle")


def test_scoring_unlabelled_rows_with_unseen_values(spark, features):
    model = fit(prepare(features), QUICK).model
    rows = features.drop("is_fraud").withColumn("merchant", F.lit("never seen"))
    scored = score(model, rows)
    assert scored.columns == ["transaction_id", "probability", "margin"]
    assert scored.where("probability between 0 and 1").count() == 2000


def test_run_stores_model_and_ledger(spark, features, tmp_path):
    path, ledger = f"{tmp_path}/date=2024-01-01", f"{tmp_path}/runs"
    features.write.parquet(path)
    found = training.run(spark, path, QUICK, ledger=ledger, models=f"{tmp_path}/models")
    assert found["run_name"] == "GBT_date-2024-01-01"
    other = training.run(spark, path, QUICK, run_name="second", ledger=ledger)
    runs = {r["run_name"]: r for r in compare_runs(spark, ledger, ["auc_roc", "auc_pr"]).collect()}
    assert set(runs) == {"GBT_date-2024-01-01", "second"}
    assert runs["second"]["auc_roc"] == other["auc_roc"] == found["auc_roc"]
    params = {
        r["key"]: r["value"]
        for r in spark.read.parquet(ledger).where("kind = 'param' and run_name = 'second'").collect()
    }
    assert params["input_path"] == path and params["max_iter"] == "4"
    loaded = load_model(f"{tmp_path}/models/GBT_date-2024-01-01")
    held_out = split(prepare(spark.read.parquet(path)), "hash", 0.8, 42)[1]
    assert training.evaluate(loaded, held_out) == {k: found[k] for k in ("auc_roc", "auc_pr")}


def test_a_loaded_model_predicts_the_same(features, tmp_path):
    model = fit(prepare(features), QUICK).model
    save_model(model, f"{tmp_path}/model")
    loaded = load_model(f"{tmp_path}/model")
    assert score(loaded, features).exceptAll(score(model, features)).count() == 0


def test_run_names(spark, tmp_path):
    assert default_run_name("gbt", "s3a://b/features/date=2024-01-01/") == "GBT_date-2024-01-01"
    first = log_run(spark, f"{tmp_path}/l", "r", {"a": 1}, {"m": 0.5})
    assert first != log_run(spark, f"{tmp_path}/l", "r", {"a": 1}, {"m": 0.5})
    assert compare_runs(spark, f"{tmp_path}/l", ["m"]).count() == 2


def plain_tree(x, y, w, step, l2, depth, least=1.0):
    """One regularised tree by trying every cut of every node; margins of the rows."""
    g, h = w * (0.5 - y), w * 0.25

    def grow(rows, left):
        best = (1e-9, None, None)
        for f in range(x.shape[1]) if left else ():
            for cut in sorted(set(x[rows, f]))[:-1]:
                low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(h[low].sum(), h[high].sum()) < least:
                    continue
                parts = [g[part].sum() ** 2 / (h[part].sum() + l2) for part in (low, high, rows)]
                if parts[0] + parts[1] - parts[2] > best[0] + 1e-9:
                    best = (parts[0] + parts[1] - parts[2], low, high)
        if best[1] is None:
            found[rows] = -step * g[rows].sum() / (h[rows].sum() + l2)
        else:
            grow(best[1], left - 1)
            grow(best[2], left - 1)

    found = np.zeros(len(y))
    grow(np.arange(len(y)), depth)
    return found


def small_matrix(spark, parts=3, n=400):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 9, n), rng.integers(0, 2, n), rng.integers(0, 5, n)], 1).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] == 1) | (rng.random(n) < 0.1)).astype(float)
    w = np.where(y > 0, 2.5, 1.0)
    rows = [(i, Vectors.dense(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, ["id", "features", "label", "weight"]).repartition(parts), x, y, w


def test_one_regularised_tree_equals_all_cuts(spark):
    matrix, x, y, w = small_matrix(spark)
    cuts = boosting.find_cuts(matrix, 3, 3)
    for l2, depth in ((0.0, 1), (1.0, 3), (50.0, 2)):
        trees = boosting.fit_trees(matrix, cuts, 1, depth, 0.3, l2=l2)
        scored = boosting.BoostedTrees.of(cuts, trees).transform(matrix).collect()
        found = {r.id: float(r.rawPrediction[1]) for r in scored}
        assert np.allclose([found[i] for i in range(len(y))], plain_tree(x, y, w, 0.3, l2, depth))


def test_regularised_trees_do_not_depend_on_partitions_and_survive_storing(spark, tmp_path, monkeypatch):
    matrix, x, y, w = small_matrix(spark)
    cuts, how = boosting.find_cuts(matrix, 3, 3), dict(rounds=5, depth=3, step=0.3, rows_share=0.8, features_share=0.7)
    a = boosting.BoostedTrees.of(cuts, boosting.fit_trees(matrix, cuts, **how))
    monkeypatch.setattr(boosting, "PENDING", 2)
    monkeypatch.setattr(boosting, "TO_DRIVER", 1)
    b = boosting.BoostedTrees.of(cuts, boosting.fit_trees(matrix.repartition(7), cuts, **how))
    for (f, c, v), (g, d, u) in zip(json.loads(a.getOrDefault(a.model))["trees"], json.loads(b.getOrDefault(b.model))["trees"]):
        assert (f, c) == (g, d) and np.allclose(v, u, atol=1e-9)
    PipelineModel([a]).write().overwrite().save(f"{tmp_path}/m")
    kept = PipelineModel.load(f"{tmp_path}/m").transform(matrix).select("id", "probability", "prediction")
    assert kept.exceptAll(a.transform(matrix).select("id", "probability", "prediction")).count() == 0
    assert kept.join(matrix, "id").filter("prediction = label").count() > 0.8 * len(y)


def test_exact_median(spark):
    values = [5.0, 1.0, 1.0, 9.5, None, float("nan"), 7.0, 2.0]
    df = spark.createDataFrame([(v, None) for v in values], "v double, none double").repartition(3)
    assert encode.exact_median(df, "v") == 2.0 and encode.exact_median(df, "none") is None
    assert encode.exact_median(spark.range(10_001).withColumn("v", F.col("id") % 777), "v") == 384
    filled = encode.imputer(df, ["v", "none"]).transform(df)
    assert filled.filter("v is null or isnan(v)").select("v_filled", "none_filled").distinct().collect() == [(2.0, 0.0)]


def test_sums_of_a_sibling_are_taken_from_the_parent(spark, monkeypatch):
    """One pass a level, over one child of each split; the trees are those of all cuts."""
    matrix, x, y, w = small_matrix(spark)
    cuts, asked, sums = boosting.find_cuts(matrix, 3, 3), [], boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda blocks, tree, wanted, *rest: asked.append(wanted) or sums(blocks, tree, wanted, *rest))
    trees = boosting.fit_trees(matrix, cuts, 1, 3, 0.3)
    assert len(asked) == 3 and asked[0] == [0] and len(asked[1]) == 1 and len(asked[2]) <= 2
    scored = boosting.BoostedTrees.of(cuts, trees).transform(matrix).collect()
    found = {r.id: float(r.rawPrediction[1]) for r in scored}
    assert np.allclose([found[i] for i in range(len(y))], plain_tree(x, y, w, 0.3, 1.0, 3))


def test_training_computes_the_features_once(spark, features):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    fit(prepare(features.mapInArrow(counted, features.schema)), TrainSpec().with_trees(max_iter=2, max_depth=2))
    assert seen.value == 2000
    seen.value = 0
    train(features.mapInArrow(counted, features.schema), TrainSpec("xgb").with_trees(max_iter=2, max_depth=2))
    assert seen.value == 2000


def test_mllib_trees_run_in_no_more_tasks_than_cores_need(spark, features, monkeypatch):
    parts, cores = [], spark.sparkContext.defaultParallelism

    class Seen:
        def fit(self, matrix):
            parts.append(matrix.rdd.getNumPartitions())
            return training.GBTClassifier(labelCol="label", maxIter=1, maxDepth=1).fit(matrix)

    monkeypatch.setattr(training, "classifier", lambda spec: Seen())
    fit(prepare(features.repartition(10 * cores)), TrainSpec())
    fit(prepare(features.repartition(3)), TrainSpec())
    monkeypatch.setattr(training, "TREE_TASK_ROWS", 2000 // (4 * cores))
    fit(prepare(features.repartition(10 * cores)), TrainSpec())
    assert parts[:2] == [training.TREE_TASKS * cores, 3] and 4 * cores <= parts[2] < 5 * cores


def test_medians_of_all_columns_share_their_passes(spark):
    rng = np.random.default_rng(5)
    columns = {
        "few": rng.integers(0, 3, 5000) * 1.0,
        "wide": rng.normal(size=5000) * 10.0 ** rng.integers(-300, 300, 5000),
        "gaps": np.where(rng.random(5000) < 0.9, np.nan, rng.random(5000)),
        "ends": np.where(rng.random(5000) < 0.6, -np.inf, np.inf),
        "two": np.where(np.arange(5000) < 2, np.arange(5000) * 1.0, np.nan),
        "zeros": np.where(rng.random(5000) < 0.5, -0.0, 0.0),
        "none": np.full(5000, np.nan),
    }
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], [*columns]).repartition(5)
    found = encode.exact_medians(df.mapInArrow(counted, df.schema), [*columns])
    numbers = [sorted(v[~np.isnan(v)]) for v in columns.values()]
    assert found == [v[(len(v) + 1) // 2 - 1] if v else None for v in numbers]
    assert seen.value <= 3 * 5000
    for n in range(1, 12):
        assert encode.exact_medians(spark.range(n), ["id"]) == [(n + 1) // 2 - 1]
    assert encode.exact_medians(spark.range(0), ["id", "id"]) == [None, None]


def test_passes_have_even_tasks_and_narrow_blocks(spark, monkeypatch):
    """Tasks are a multiple of the cores, features of two bins share columns; the trees are those of all cuts."""
    rng, n, cores = np.random.default_rng(7), 600, spark.sparkContext.defaultParallelism
    x = np.hstack([rng.integers(0, 9, (n, 1)), rng.integers(0, 5, (n, 1)), rng.integers(0, 2, (n, 7))]).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 4] == 1) | (x[:, 7] == 1) & (x[:, 1] > 2)).astype(float)
    rows = [(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    matrix = spark.createDataFrame(rows, ["id", "features", "label"]).repartition(4 * cores)
    seen, sums = [], boosting._histograms
    monkeypatch.setattr(boosting, "TASK_ROWS", n // (cores + 1))
    monkeypatch.setattr(boosting, "_histograms", lambda blocks, *rest: seen.append(blocks) or sums(blocks, *rest))
    cuts = boosting.find_cuts(matrix, 2, 9)
    for weights in (np.where(y > 0, 3.0, 1.0), 1.0 + np.arange(n) % 3):
        weighted = matrix.withColumn("weight", F.element_at(F.array(*map(F.lit, weights.tolist())), (F.col("id") + 1).cast("int")))
        trees = boosting.fit_trees(weighted, cuts, 1, 3, 0.3)
        assert seen[-1].getNumPartitions() == 2 * cores
        scored = boosting.BoostedTrees.of(cuts, trees).transform(matrix).collect()
        found = {r.id: float(r.rawPrediction[1]) for r in scored}
        assert np.allclose([found[i] for i in range(n)], plain_tree(x, y, weights, 0.3, 1.0, 3))
    assert [c for c, _ in boosting.places_of(cuts)] == [0, 1, 2, 2, 2, 3, 3, 3, 4]
    assert boosting.places_of([[0.5]] * 3) == [(0, 0), (1, 0), (2, 0)]
