import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerlark.jobs import build_features as features_job
from ledgerlark.jobs import generate as generate_job
from ledgerlark.jobs import ingest as ingest_job
from ledgerlark.jobs import train as train_job
from ledgerlark.operators.decode import with_event_time
from ledgerlark.plans import features
from ledgerlark.plans.features import build_features, keep_existing
from ledgerlark.schema import FEATURES
from ledgerlark.session import fresh_dir, shared_dir
from ledgerlark.sinks.tables import write_run
from ledgerlark.sources.tables import scan_silver


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Three days of one transaction per user and hour."""
    root = f"{tmp_path_factory.mktemp('base')}/silver"
    i = F.col("id")
    rows = spark.range(72 * 3).select(
        i.cast("string").alias("transaction_id"),
        (i % 3 + 1000).cast("int").alias("user_id"),
        (i + 1).cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("m").alias("merchant"),
        F.date_format(
            (F.lit(1704067200) + F.floor(i / 3) * 3600).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxxx"
        ).alias("timestamp"),
        F.lit("US").alias("location"),
        (i % 9 == 0).cast("int").alias("is_fraud"),
    )
    with_event_time(rows).write.partitionBy("event_date").parquet(root)
    return root


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_columns_and_invariants(spark, silver):
    table = build_features(scan_silver(spark, silver))
    assert table.columns == FEATURES
    assert table.where("u_txn_cnt_24h < u_txn_cnt_1h or u_txn_cnt_1h < 1").count() == 0
    # Both ends of a frame count: 2 within an hour, 25 within a day.
    last = table.orderBy(F.desc("event_ts")).head()
    assert (last["u_txn_cnt_1h"], last["u_txn_cnt_24h"]) == (2, 25)


def test_other_spans(spark, silver):
    table = build_features(scan_silver(spark, silver), {"2h": 7200})
    assert "u_txn_cnt_2h" in table.columns and "u_txn_cnt_1h" not in table.columns
    assert table.columns[-1] == "is_fraud"


def test_missing_columns_are_left_out(spark, silver):
    table = build_features(scan_silver(spark, silver).drop("merchant", "location"))
    assert table.columns == [c for c in FEATURES if c not in ("merchant", "location")]
    assert keep_existing(table, ["nothing", "amount"]).columns == ["amount"]


def test_date_range_reads_a_day_more_than_it_emits(spark, silver, tmp_path):
    day = dt.date(2024, 1, 3)
    path = features.run(spark, silver, str(tmp_path), "r", (day, day))
    ranged = spark.read.parquet(path)
    whole = build_features(scan_silver(spark, silver)).where(F.to_date("event_ts") == F.lit(day))
    assert ranged.count() == 72 and same(ranged, whole)
    pruned = scan_silver(spark, silver, (day, day))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and pruned.count() == 72


def test_scan_reads_only_what_features_need(spark, silver):
    table = build_features(scan_silver(spark, silver), method="by_row")
    plan = table._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "event_time" not in schema and "amount" in schema
    assert plan.count("Exchange") == 1 and plan.count("Window [") == 1


def test_a_run_replaces_only_its_date(spark, tmp_path):
    out = str(tmp_path)
    for date, n in (("2024-01-01", 5), ("2024-01-02", 6), ("2024-01-01", 7)):
        path = write_run(spark.range(n), out, date, files=1)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1
    counts = spark.read.parquet(out).groupBy("date").count().orderBy("date").collect()
    assert [r["count"] for r in counts] == [7, 6]
    today = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    assert write_run(spark.range(1), out).endswith(f"date={today}")


def test_scratch_paths_are_new_and_below_the_shared_folder(spark):
    one, two = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert one != two and one.startswith(shared_dir(spark) + "/x-")


def test_jobs_from_generation_to_a_model(spark, tmp_path, monkeypatch):
    """The command-line jobs, one after the other."""
    root = str(tmp_path)
    generate_job.main(["--rows", "3000", "--high-risk-share", "0.3", "--output", f"{root}/landing"])
    ingest_job.main(
        ["--landing", f"{root}/landing", "--tables", root, "--checkpoints", f"{root}/ckpt", "--drain"]
    )
    assert scan_silver(spark, f"{root}/silver").count() == 3000
    path = features_job.main(
        ["--input", f"{root}/silver", "--output", f"{root}/features", "--date", "2024-01-01"]
    )
    assert spark.read.parquet(path).count() == 3000
    found = train_job.main(
        ["--input", path, "--max-iter", "2", "--ledger", f"{root}/runs", "--models", f"{root}/m"]
    )
    assert found["run_name"] == "GBT_date-2024-01-01" and 0 <= found["auc_roc"] <= 1
