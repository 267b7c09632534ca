"""Test tables seen as transactions and messages (FIXTURES.md, F1 to F5)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.schema import KAFKA, PAYLOAD
from ledgerlark.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def iso_text(ts) -> F.Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def from_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """F1; ``extra`` keeps raw columns such as ``ts`` or ``event_id``."""
    places = F.array(*[F.lit(c) for c in ("CN", "RU", "GB", "US", "DE")])
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        (F.col("user_id") + 1000).cast("int").alias("user_id"),
        F.round(F.col("value") * 20, 2).alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("merchant"),
        iso_text("ts").alias("timestamp"),
        F.element_at(places, (F.col("event_id") % 5 + 1).cast("int")).alias("location"),
        (F.col("event_id") % 50 == 0).cast("int").alias("is_fraud"),
        *extra,
    )


def from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whole days, so many rows of a customer can share a second."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("o_orderpriority").alias("merchant"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderstatus").alias("location"),
        (F.col("o_orderkey") % 50 == 0).cast("int").alias("is_fraud"),
    )


def from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """few users, many rows each."""
    name = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        name.alias("transaction_id"),
        F.col("l_suppkey").cast("int").alias("user_id"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("l_returnflag").alias("merchant"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_linestatus").alias("location"),
        (F.col("l_orderkey") % 50 == 0).cast("int").alias("is_fraud"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped rows, with repeated payloads and values that are not JSON."""
    rows = from_events(spark, sf_dir, "event_id", "ts")
    sent = F.col("ts").cast("timestamp") + F.expr("interval 5 seconds")
    payload = F.to_json(F.struct(*PAYLOAD))
    key, every_10th = F.col("transaction_id"), F.col("event_id") % 10 == 0
    later = sent + F.expr("interval 1 second")
    bad = F.col("event_id") % 101 == 0
    # One row per message that the event gives rise to.
    message = F.explode(
        F.array_compact(
            F.array(
                F.struct(key.alias("key"), payload.alias("value"), sent.alias("timestamp")),
                F.when(
                    every_10th,
                    F.struct(key.alias("key"), payload.alias("value"), later.alias("timestamp")),
                ),
                F.when(
                    bad,
                    F.struct(
                        F.concat(F.lit("bad-"), key).alias("key"),
                        F.lit("not json").alias("value"),
                        sent.alias("timestamp"),
                    ),
                ),
            )
        )
    )
    return rows.select("event_id", message.alias("m")).select(
        F.col("m.key").cast("binary").alias("key"),
        F.col("m.value").cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        (F.col("event_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("m.timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).select(*KAFKA.fieldNames())
