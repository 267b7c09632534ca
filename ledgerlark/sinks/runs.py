"""Run ledger and model store."""

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LEDGER = "run_id string, run_name string, at timestamp, kind string, key string, value string"


def default_run_name(model: str, input_path: str) -> str:
    """E.g. ``GBT_date-2024-01-01`` for an input ending in ``date=2024-01-01``."""
    last = input_path.rstrip("/").rsplit("/", 1)[-1]
    return f"{model.upper()}_{last.replace('=', '-')}"


def log_run(
    spark: SparkSession,
    ledger: str,
    run_name: str,
    params: dict[str, object],
    metrics: dict[str, float],
    artifacts: dict[str, str] | None = None,
) -> str:
    """Appends one row per parameter, metric and artifact; returns the new run id."""
    run_id = uuid.uuid4().hex
    now = dt.datetime.now(dt.timezone.utc)
    entries = [
        (run_id, run_name, now, kind, key, str(value))
        for kind, values in (("param", params), ("metric", metrics), ("artifact", artifacts or {}))
        for key, value in values.items()
    ]
    rows = spark.createDataFrame(entries, _LEDGER)
    rows.coalesce(1).write.mode("append").parquet(ledger)
    return run_id


def compare_runs(spark: SparkSession, ledger: str, metrics: list[str]) -> DataFrame:
    """One row per run with the given metrics as columns."""
    rows = spark.read.schema(_LEDGER).parquet(ledger).where("kind = 'metric'")
    return rows.groupBy("run_id", "run_name", "at").agg(
        *[
            F.max(F.when(F.col("key") == m, F.col("value").try_cast("double"))).alias(m)
            for m in metrics
        ]
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
