"""Keyed JSON messages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources.streams import KafkaTopic


def encode(transactions: DataFrame) -> DataFrame:
    """``key`` = transaction id, ``value`` = the whole row as JSON, both as bytes."""
    return transactions.select(
        F.col("transaction_id").cast("binary").alias("key"),
        F.to_json(F.struct("*")).cast("binary").alias("value"),
    )


def publish(transactions: DataFrame, topic: KafkaTopic) -> None:
    """Writes every row to the topic, straight from the executors."""
    options = topic.connection() | {"topic": topic.topic}
    encode(transactions).write.format("kafka").options(**options).save()
