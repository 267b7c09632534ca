"""Message bytes to typed, event-timed rows. The same functions serve batch and stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.once import one_row
from ledgerlark.functions.time import parse_timestamp
from ledgerlark.schema import TRANSACTION


def to_bronze(messages: DataFrame) -> DataFrame:
    """Raw text, broker time and ingest time of each message."""
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_ts"),
        F.current_timestamp().alias("ingest_ts"),
    )


def decode(bronze: DataFrame) -> DataFrame:
    """Typed columns from the raw JSON.

    Text that is not JSON gives NULL in every field, an ill-typed value only in its own.
    """
    fields = one_row(F.from_json("raw_json", TRANSACTION))
    return bronze.select(fields, "kafka_ts", "ingest_ts")


def with_event_time(decoded: DataFrame) -> DataFrame:
    timed = decoded.withColumn("event_time", parse_timestamp(F.col("timestamp")))
    return timed.withColumn("event_date", F.to_date("event_time"))


def undecodable(bronze: DataFrame) -> DataFrame:
    """Raw rows that decoding cannot key by a transaction id, with the reason."""
    parsed = F.from_json("raw_json", TRANSACTION)
    reason = F.when(F.try_parse_json("raw_json").isNull(), "not JSON").otherwise(
        "no transaction_id"
    )
    return bronze.where(parsed["transaction_id"].isNull()).withColumn("reason", reason)
