import datetime as dt
import json

import time

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.decode import to_bronze
from ledgerlark.plans.ingest import to_silver
from ledgerlark.schema import KAFKA
from ledgerlark.sources.streams import (
    KafkaTopic,
    LandingFolder,
    open_bronze,
    open_stream,
    plain_login,
)
from ledgerlark.sources.tables import scan_silver
from ledgerlark.streaming import ingest
from ledgerlark.streaming.accounted import scan_account, scan_accounted, write_batch

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def root(spark, tmp_path):
    ingest.configure_state(spark)
    return str(tmp_path)


def land(spark, root, *messages):
    """Appends (id, hh:mm:ss or raw text) messages as one step of the topic."""
    rows = []
    for name, at in messages:
        value = at
        if ":" in at:
            value = json.dumps(
                {"transaction_id": name, "user_id": 1000, "amount": 1.5, "currency": "USD",
                 "timestamp": f"2024-01-01T{at}+00:00", "is_fraud": 0}
            )
        rows.append((name.encode(), value.encode(), "t", 0, len(rows), DAY, 0))
    spark.createDataFrame(rows, KAFKA).write.mode("append").parquet(f"{root}/landing")


def drain(spark, root, **how):
    queries = ingest.start_ingest(
        spark, LandingFolder(f"{root}/landing"), root, f"{root}/ckpt", drain=True, **how
    )
    for q in queries:
        q.awaitTermination()
    return queries


def ids(spark, root):
    return sorted(r[0] for r in scan_silver(spark, f"{root}/silver").select("transaction_id").collect())


def state_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


LATE = [
    [("a", "00:00:00")],
    [("b", "02:00:00")],
    [("late", "00:30:00"), ("b", "02:00:01"), ("c", "02:00:02")],
    [("d", "04:00:00")],
]


@pytest.mark.parametrize("mode", ["forever", "watermark"])
def test_late_rows_and_repeats_are_dropped(spark, root, mode):
    late = ingest.count_late_rows(spark)
    # Spark keeps one report here, the count must not depend on that.
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        for step in LATE:
            land(spark, root, *step)
            silver = drain(spark, root, watermark_minutes=10, mode=mode)[1]
        assert ids(spark, root) == ["a", "b", "c", "d"]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        for _ in range(50):
            if late.dropped(silver):
                break
            time.sleep(0.1)
        assert late.dropped(silver) == 1
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(late)


def test_a_longer_delay_keeps_the_late_row(spark, root):
    for step in LATE:
        land(spark, root, *step)
        drain(spark, root, watermark_minutes=180)
    assert ids(spark, root) == ["a", "b", "c", "d", "late"]


def test_state_grows_for_ever_or_expires(spark, root):
    held = {}
    for mode in ("forever", "watermark"):
        base = f"{root}/{mode}"
        for step in LATE:
            land(spark, base, *step)
            silver = drain(spark, base, watermark_minutes=10, mode=mode)[1]
        held[mode] = state_rows(silver)[-1]
    assert held == {"forever": 4, "watermark": 1}


def test_an_expired_key_may_come_back(spark, root):
    for step in ([("a", "00:00:00")], [("b", "06:00:00")], [("a", "06:00:01")]):
        land(spark, root, *step)
        drain(spark, root, watermark_minutes=10, mode="watermark")
    assert ids(spark, root) == ["a", "a", "b"]


def test_restart_loses_and_repeats_nothing(spark, root):
    land(spark, root, ("a", "00:00:00"), ("b", "00:00:01"))
    drain(spark, root)
    land(spark, root, ("b", "00:00:01"), ("c", "00:00:02"))
    drain(spark, root)
    drain(spark, root)
    assert ids(spark, root) == ["a", "b", "c"]
    assert spark.read.parquet(f"{root}/bronze").count() == 4


def test_bad_messages_reach_quarantine_only(spark, root):
    land(spark, root, ("a", "00:00:00"), ("x", "junk"), ("y", "junk"))
    drain(spark, root)
    assert ids(spark, root) == ["a"]
    assert spark.read.parquet(f"{root}/quarantine").count() == 2
    assert spark.read.parquet(f"{root}/bronze").count() == 3


def test_keep_bad_keeps_one_for_all(spark, root):
    land(spark, root, ("a", "00:00:00"), ("x", "junk"), ("y", "junk"))
    assert len(drain(spark, root, keep_bad=True)) == 2
    rows = scan_silver(spark, f"{root}/silver").collect()
    assert sorted(str(r["transaction_id"]) for r in rows) == ["None", "a"]
    assert [r["event_date"] for r in rows if r["transaction_id"] is None] == [None]


def test_stream_equals_batch(spark, root):
    land(spark, root, ("a", "00:00:00"), ("a", "00:00:00"), ("b", "23:59:59"), ("x", "junk"))
    drain(spark, root, silver_from_bronze=True)
    messages = spark.read.schema(KAFKA).parquet(f"{root}/landing")
    columns = ["transaction_id", "user_id", "amount", "event_time", "event_date"]
    batch = to_silver(to_bronze(messages)).select(columns)
    stream = scan_silver(spark, f"{root}/silver").select(columns)
    assert batch.exceptAll(stream).count() == stream.exceptAll(batch).count() == 0
    assert stream.count() == 2


def test_uncommitted_files_are_not_read(spark, root):
    land(spark, root, ("a", "00:00:00"))
    drain(spark, root)
    orphan = scan_silver(spark, f"{root}/silver").drop("event_date")
    orphan.write.mode("append").parquet(f"{root}/silver/event_date=2024-01-01")
    assert ids(spark, root) == ["a"]


def test_files_per_trigger_bound_a_batch(spark, root):
    for i in range(3):
        land(spark, root, (f"m{i}", "00:00:00"))
    files = spark.read.schema(KAFKA).parquet(f"{root}/landing").select(F.input_file_name()).distinct().count()
    source = LandingFolder(f"{root}/landing", max_files_per_trigger=1)
    query = ingest.start_bronze(open_stream(spark, source), f"{root}/b", f"{root}/c", drain=True)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3 <= files
    assert open_bronze(spark, f"{root}/b").isStreaming


def test_unknown_mode(spark, root):
    land(spark, root, ("a", "00:00:00"))
    messages = LandingFolder(f"{root}/landing").open(spark)
    with pytest.raises(ValueError):
        to_silver(to_bronze(messages), mode="sometimes")


def test_kafka_options():
    topic = KafkaTopic(
        "h:1", "transactions", "earliest", "SASL_SSL", "PLAIN", "me", 'p"w\\',
        max_offsets_per_trigger=1000,
    )
    assert topic.reader() == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "transactions",
        "startingOffsets": "earliest",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": plain_login("me", 'p"w\\'),
        "maxOffsetsPerTrigger": "1000",
    }
    assert 'p"w' not in repr(topic)
    assert plain_login("u", 'a"b').endswith('username="u" password="a\\"b";')
    assert set(KafkaTopic("h:1", "t").connection()) == {"kafka.bootstrap.servers"}


def test_a_login_is_never_sent_in_plain():
    login = KafkaTopic("h:1", "t", username="me", password="p").connection()
    assert login["kafka.security.protocol"] == "SASL_SSL" and login["kafka.sasl.mechanism"] == "PLAIN"
    assert KafkaTopic("h:1", "t").reader()["startingOffsets"] == "earliest"
    free = KafkaTopic("h:1", "t", options={"kafka.compression.type": "gzip"})
    assert free.connection()["kafka.compression.type"] == "gzip"


def test_a_table_of_ids_refuses_the_first_id_in_the_last_batch(spark, root):
    path = f"{root}/silver"
    for n in range(8):
        again = [("n0", "05:00:00"), ("n0", f"05:0{n}:01")] if n else []
        land(spark, root, (f"n{n}", f"05:0{n}:00"), *again, ("late", "03:00:00"), ("bad", "no json"))
        drain(spark, root, mode="table")
    rows = scan_accounted(spark, path).select("transaction_id", "batch", "event_time").collect()
    # "late" is on time in the first batch, whose watermark is not known yet.
    assert sorted(r[0] for r in rows) == sorted(["late", *[f"n{n}" for n in range(8)]])
    account = [tuple(r)[:4] for r in scan_account(spark, path).orderBy("batch").collect()]
    assert account == [(2, 0, 0, 2)] + [(4, 1, 2, 1)] * 7


def test_a_batch_that_runs_again_gives_the_same(spark, root):
    path = f"{root}/silver"
    messages = [[("a", "01:00:00"), ("b", "01:00:01")], [("a", "01:00:02"), ("c", "01:00:03"), ("x", "00:00:00")], [("x", "00:00:00")]]
    steps = []
    for n, step in enumerate(messages):
        land(spark, f"{root}/{n}", *step)
        steps.append(to_bronze(spark.read.parquet(f"{root}/{n}/landing")))
    for n in (0, 1, 0, 1, 1):
        write_batch(steps[n], n, path, 30)
    # A batch without an account is not there yet.
    steps[0].select(F.current_date().alias("event_date"), F.lit("new").alias("transaction_id")).write.partitionBy("event_date").parquet(f"{path}/batch=9")
    seen = scan_accounted(spark, path).select("transaction_id", "batch").collect()
    assert sorted(map(tuple, seen)) == [("a", 0), ("b", 0), ("c", 1)]
    # Nothing is kept of a batch in which everything is late, and the next one goes on from there.
    write_batch(steps[2], 2, path, 30)
    assert [tuple(r)[:4] for r in scan_account(spark, path).orderBy("batch").collect()] == [(2, 0, 0, 2), (3, 1, 1, 1), (1, 1, 0, 0)]
    assert scan_accounted(spark, path).count() == 3
    write_batch(steps[0].limit(0), 3, path, 30)
    assert [r.latest.minute for r in scan_account(spark, path).orderBy("batch").collect()] == [0, 0, 0, 0]
