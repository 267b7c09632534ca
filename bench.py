"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs twice; the second run counts. ``per_user_window_*`` is the plain form of the
rolling features, one window per user over the same input, for comparison.
"""

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contract import bindings as given
from contract.queries import QUERIES
from ledgerlark.functions.time import as_timestamp, epoch_seconds, with_time_parts
from ledgerlark.operators import rolling
from ledgerlark.operators.checks import validate_json
from ledgerlark.operators.ranking import ranking_metrics
from ledgerlark.plans.features import build_features
from ledgerlark.operators.decode import to_bronze
from ledgerlark.plans.ingest import to_silver
from ledgerlark.session import use_utc

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SOURCES = {
    "events": given.from_events,
    "orders": given.from_orders,
    "lineitem": given.from_lineitem,
}


def window_per_user(rows: DataFrame) -> DataFrame:
    timed = rows.withColumn("event_ts", as_timestamp(rows, "timestamp"))
    timed = with_time_parts(timed).withColumn("_second", epoch_seconds(timed, "event_ts"))
    ordered = Window.partitionBy("user_id").orderBy("_second")
    found = {}
    for name, span in rolling.SPANS.items():
        frame = ordered.rangeBetween(-span, 0)
        found[f"u_txn_cnt_{name}"] = F.count(F.lit(1)).over(frame)
        found[f"u_amt_sum_{name}"] = F.sum("amount").over(frame)
        found[f"u_amt_avg_{name}"] = F.avg("amount").over(frame)
    return timed.withColumns(found).drop("_second", "timestamp")


def headline(spark: SparkSession) -> dict:
    def messages():
        return to_bronze(given.messages(spark, SF_DIR))

    runs = {}
    for name, source in SOURCES.items():
        runs[f"features_{name}"] = lambda s=source: build_features(s(spark, SF_DIR))
        runs[f"per_user_window_{name}"] = lambda s=source: window_per_user(s(spark, SF_DIR))
    for method in (rolling.BY_ROW, rolling.BY_SECOND):
        runs[f"features_lineitem_{method}"] = lambda m=method: build_features(
            given.from_lineitem(spark, SF_DIR), method=m
        )
    runs["silver_dedup"] = lambda: to_silver(messages())
    runs["stream_ingest"] = lambda: QUERIES["stream_silver_dedup"](spark, SF_DIR)
    runs["validate_json"] = lambda: validate_json(messages())[1]
    runs["generate"] = lambda: QUERIES["gen_transactions"](spark, SF_DIR)
    runs["auc_exact"] = lambda: ranking_metrics(
        given.from_events(spark, SF_DIR).withColumnRenamed("is_fraud", "label"), "amount"
    )
    return runs


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    seconds = {}
    for name, make in headline(spark).items():
        timed(make)
        seconds[name] = timed(make)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = sum(v for k, v in seconds.items() if not k.startswith("per_user_window_"))
    rows = {n: given.table(spark, SF_DIR, n).count() for n in SOURCES}
    line = {
        "metric": "headline queries, total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {
            f"features_{n}": round(rows[n] / seconds[f"features_{n}"]) for n in SOURCES
        }
        | {"stream_ingest": round(rows["events"] * 1.11 / seconds["stream_ingest"])},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
