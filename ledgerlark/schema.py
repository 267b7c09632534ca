"""Schemas shared by the batch and the streaming side."""

from pyspark.sql.types import StructType


def _schema(**fields: str) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


# The wire contract of a transaction message.
TRANSACTION = _schema(
    transaction_id="string",
    user_id="integer",
    amount="double",
    currency="string",
    merchant="string",
    timestamp="string",
    location="string",
    is_fraud="integer",
)
PAYLOAD = TRANSACTION.fieldNames()

# Row layout of Spark's Kafka source.
KAFKA = _schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

BRONZE = _schema(raw_json="string", kafka_ts="timestamp", ingest_ts="timestamp")

# Column order of the feature table.
FEATURES = [
    "transaction_id",
    "user_id",
    "amount",
    "currency",
    "merchant",
    "location",
    "event_ts",
    "hour",
    "dayofweek",
    "u_txn_cnt_1h",
    "u_amt_sum_1h",
    "u_amt_avg_1h",
    "u_txn_cnt_24h",
    "u_amt_sum_24h",
    "u_amt_avg_24h",
    "is_fraud",
]

CATEGORICAL = ["currency", "merchant", "location"]
