import datetime as dt

from pyspark.sql import functions as F

from ledgerlark.functions.time import as_timestamp, epoch_seconds, with_time_parts
from ledgerlark.operators.decode import decode, to_bronze, undecodable, with_event_time
from ledgerlark.operators.dedup import first_per_key
from ledgerlark.plans.ingest import to_silver
from ledgerlark.schema import BRONZE, KAFKA, PAYLOAD

NOW = dt.datetime(2024, 1, 1, 12)


def bronze(spark, *texts):
    return spark.createDataFrame([(t, NOW, NOW) for t in texts], BRONZE)


def test_bronze_stamp_is_one_value(spark):
    rows = [(b"k", b'{"a":1}', "t", 0, i, NOW, 0) for i in range(5)]
    found = to_bronze(spark.createDataFrame(rows, KAFKA).repartition(3))
    assert found.columns == BRONZE.fieldNames()
    stamps = {r["ingest_ts"] for r in found.collect()}
    assert len(stamps) == 1 and None not in stamps


def test_decode_nulls_only_what_is_wrong(spark):
    rows = decode(
        bronze(
            spark,
            "not json",
            '{"transaction_id":"a","user_id":1000.5,"amount":1.5}',
            '{"transaction_id":"b","user_id":1001,"amount":"x"}',
            '{"transaction_id":"c","extra":1}',
            None,
        )
    ).collect()
    assert [r["transaction_id"] for r in rows] == [None, "a", "b", "c", None]
    assert (rows[1]["user_id"], rows[1]["amount"]) == (None, 1.5)
    assert (rows[2]["user_id"], rows[2]["amount"]) == (1001, None)
    assert all(rows[0][c] is None for c in PAYLOAD)


def test_bad_time_text_is_null_not_an_error(spark):
    texts = ['{"transaction_id":"a","timestamp":"soon"}',
             '{"transaction_id":"b","timestamp":"2024-01-01T23:30:00-02:00"}']
    rows = with_event_time(decode(bronze(spark, *texts))).collect()
    assert rows[0]["event_time"] is None and rows[0]["event_date"] is None
    assert rows[1]["event_date"] == dt.date(2024, 1, 2)


def test_undecodable_gives_the_reason(spark):
    rows = undecodable(bronze(spark, "oops", '{"amount":1}', '{"transaction_id":"a"}', None))
    assert sorted(r["reason"] for r in rows.collect()) == [
        "no transaction_id", "not JSON", "not JSON"]


def test_good_and_bad_rows_add_up(spark):
    source = bronze(spark, "oops", "oops", '{"transaction_id":"a"}', '{"transaction_id":"b"}')
    good, bad = to_silver(source), undecodable(source)
    assert good.count() + bad.count() == source.count()
    assert to_silver(source, keep_bad=True).count() == 3


def test_first_arrival_wins(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), (None, 1, "n1"), (None, 0, "n0")]
    df = spark.createDataFrame(rows, "id string, at int, what string").repartition(4)
    found = {r["id"]: r["what"] for r in first_per_key(df, "id", ["at"]).collect()}
    assert found == {"a": "early", "b": "only", None: "n0"}


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("id"), F.col("id").alias("at"))
    plan = first_per_key(df, "id", ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("1, Final") < plan.index("Exchange") < plan.index("1, Partial")


def test_timestamp_from_text_timestamp_and_ntz(spark):
    df = spark.sql(
        "select '2024-01-07T10:00:00.5+00:00' as a, timestamp'2024-01-07 10:00:00.5' as b,"
        " timestamp_ntz'2024-01-07 10:00:00.5' as c, 'x' as d"
    )
    for c in "abc":
        timed = df.withColumn("t", as_timestamp(df, c))
        row = with_time_parts(timed, "t").withColumn("s", epoch_seconds(timed, "t")).head()
        assert (row["hour"], row["dayofweek"], row["s"]) == (10, 1, 1704621600)
    assert df.select(as_timestamp(df, "d")).head()[0] is None
    assert df.select(epoch_seconds(df, "c")).head()[0] == 1704621600
