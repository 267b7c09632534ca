"""Feature table to a fitted fraud model with its metrics."""

from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import encode
from ledgerlark.operators.boosting import BoostedTrees, find_cuts, fit_trees
from ledgerlark.operators.balance import positive_weight, with_event_seconds, with_label
from ledgerlark.operators.ranking import ranking_metrics
from ledgerlark.operators.split import split
from ledgerlark.session import ensure_checkpoint_dir, stored
from ledgerlark.sinks.runs import default_run_name, log_run, save_model
from ledgerlark.sources.tables import scan_features


#: MLlib's trees run two stages for every level of every tree: a stage has so many tasks for each core at most, unless
#: a task would hold more than so many rows.
TREE_TASKS = 2
TREE_TASK_ROWS = 1 << 19


@dataclass(frozen=True)
class Boosting:
    max_iter: int
    step_size: float
    max_depth: int = 6
    subsampling_rate: float = 0.8
    # Share of the features a split may use.
    features: str = "all"
    # Weigh positives by the class imbalance.
    weighted: bool = False
    # With a penalty, trees are grown by ``operators.boosting``, and features are drawn for each tree.
    l2: float | None = None


# The two model kinds and their parameters. The second stands in for a library of its own.
MODELS = {
    "gbt": Boosting(max_iter=120, step_size=0.1),
    "xgb": Boosting(max_iter=400, step_size=0.08, features="0.8", weighted=True, l2=1.0),
}


@dataclass(frozen=True)
class TrainSpec:
    model: str = "gbt"
    seed: int = 42
    split: str = "hash"
    train_share: float = 0.8
    fill: str = "median"
    max_categories: int | None = None
    boosting: Boosting | None = None

    def __post_init__(self):
        if self.model.lower() not in MODELS:
            raise ValueError(f"model is one of {sorted(MODELS)}, not {self.model!r}")

    @property
    def trees(self) -> Boosting:
        return self.boosting or MODELS[self.model.lower()]

    def with_trees(self, **changes) -> "TrainSpec":
        return replace(self, boosting=replace(self.trees, **changes))


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    params: dict[str, object] = field(default_factory=dict)


def prepare(features: DataFrame) -> DataFrame:
    """Adds ``label`` and ``event_ts_unix``; rows without a label are left out."""
    return with_event_seconds(with_label(features))


def encoder(train: DataFrame, spec: TrainSpec) -> tuple[list, list[str]]:
    """Stages from raw columns to ``features``, and the assembled columns."""
    numeric = encode.numeric_features(train)
    categorical = encode.categorical_features(train)
    stages = [encode.imputer(train, numeric, spec.fill)] if numeric else []
    if categorical:
        stages.append(encode.category_indexer(train, categorical, spec.max_categories))
        stages.append(encode.one_hot(categorical))
    assembled = [f"{c}_filled" for c in numeric] + [f"{c}_ohe" for c in categorical]
    return [*stages, encode.assembler(assembled)], assembled


def classifier(spec: TrainSpec) -> GBTClassifier:
    trees = spec.trees
    boosted = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=trees.max_iter,
        maxDepth=trees.max_depth,
        stepSize=trees.step_size,
        subsamplingRate=trees.subsampling_rate,
        featureSubsetStrategy=trees.features,
        seed=spec.seed,
    )
    return boosted.setWeightCol("weight") if trees.weighted else boosted


def regularised(matrix: DataFrame, numeric: int, spec: TrainSpec) -> BoostedTrees:
    """Second-order trees with an L2 penalty; the first ``numeric`` features are numbers, the rest 0 or 1."""
    trees, first = spec.trees, matrix.select("features").head()
    cuts = find_cuts(matrix, numeric, first.features.size if first else numeric)
    grown = fit_trees(
        matrix,
        cuts,
        trees.max_iter,
        trees.max_depth,
        trees.step_size,
        l2=trees.l2,
        rows_share=trees.subsampling_rate,
        features_share=1.0 if trees.features == "all" else float(trees.features),
        seed=spec.seed,
    )
    return BoostedTrees.of(cuts, grown)


def fit(train: DataFrame, spec: TrainSpec) -> Trained:
    """Fits encoders and trees on the training rows; ``train`` is a ``prepare``d frame."""
    rows = _kept(train)
    try:
        return _fit(rows, spec)
    finally:
        rows.unpersist()


def _kept(rows: DataFrame, *keys: str) -> DataFrame:
    """What training reads, and the keys, kept in memory or on disk: medians, categories, cuts and trees take
    many passes, and each would compute the features again. Partitions and the order of rows stay, on which
    the rows that MLlib draws depend."""
    used = {"label", *keys, *encode.numeric_features(rows), *encode.categorical_features(rows)}
    return rows.select(*[c for c in rows.columns if c in used]).persist()


def _in_few_tasks(matrix: DataFrame, rows: int) -> DataFrame:
    """The same rows in no more partitions than the cores need. Kept rows have as many as the shuffle that made them,
    which Spark does not merge, and hundreds of tasks a stage take longer to start than to run."""
    cores = matrix.sparkSession.sparkContext.defaultParallelism
    most = max(TREE_TASKS * cores, -(-rows // TREE_TASK_ROWS))
    # Coalescing no more than that would still number the partitions anew, and MLlib draws rows by their numbers.
    return matrix.coalesce(most) if matrix.rdd.getNumPartitions() > most else matrix


def _fit(train: DataFrame, spec: TrainSpec) -> Trained:
    ensure_checkpoint_dir(train.sparkSession)
    stages, assembled = encoder(train, spec)
    encoders = Pipeline(stages=stages).fit(train)
    params = {"model_type": spec.model, "num_features": len(assembled), **asdict(spec.trees)}
    matrix = encoders.transform(train)
    columns = ["features", "label"]
    if spec.trees.weighted:
        params["scale_pos_weight"] = weight = positive_weight(train)
        matrix = matrix.withColumn("weight", F.when(F.col("label") > 0, weight).otherwise(1.0))
        columns.append("weight")
    matrix = matrix.select(*columns)
    if spec.trees.l2 is None:
        trees = classifier(spec).fit(_in_few_tasks(matrix, train.count()))
    else:
        trees = regularised(matrix, len(encode.numeric_features(train)), spec)
    return Trained(PipelineModel([*encoders.stages, trees]), {}, params)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``transaction_id``, ``probability`` of fraud and the model's ``margin``; the label too, if
    there is one."""
    rows = with_event_seconds(features) if "event_ts_unix" not in features.columns else features
    scored = model.transform(rows)
    kept = [c for c in ("transaction_id", "label") if c in scored.columns]
    return scored.select(
        *kept,
        vector_to_array("probability")[1].alias("probability"),
        vector_to_array("rawPrediction")[1].alias("margin"),
    )


def evaluate(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    # The metrics take several passes over the scores; every one would run all trees again.
    scores = stored(score(model, test).select("margin", "label"), "scores")
    found = ranking_metrics(scores, "margin").head()
    return {k: float("nan") if v is None else v for k, v in found.asDict().items()}


def train(features: DataFrame, spec: TrainSpec | None = None) -> Trained:
    """Split, fit, and evaluate on the held-out part."""
    spec = spec or TrainSpec()
    rows = _kept(prepare(features), "transaction_id", "event_ts")
    try:
        train_part, test_part = split(rows, spec.split, spec.train_share, spec.seed)
        fitted = _fit(train_part, spec)
        return replace(fitted, metrics=evaluate(fitted.model, test_part))
    finally:
        rows.unpersist()


def run(
    spark: SparkSession,
    input_path: str,
    spec: TrainSpec | None = None,
    run_name: str | None = None,
    ledger: str | None = None,
    models: str | None = None,
) -> dict[str, object]:
    """Trains on a stored feature table; records the run and stores the model where asked."""
    spec = spec or TrainSpec()
    name = run_name or default_run_name(spec.model, input_path)
    trained = train(scan_features(spark, input_path), spec)
    artifacts = {}
    if models is not None:
        artifacts["model"] = f"{models}/{name}"
        save_model(trained.model, artifacts["model"])
    if ledger is not None:
        params = {"input_path": input_path, **trained.params}
        log_run(spark, ledger, name, params, trained.metrics, artifacts)
    return {**trained.metrics, "run_name": name}
