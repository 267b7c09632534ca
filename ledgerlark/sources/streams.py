"""Streaming scans: a Kafka topic, or a landing folder of rows with the same columns."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.schema import BRONZE, KAFKA


def _quoted(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def plain_login(username: str, password: str) -> str:
    """JAAS line for SASL/PLAIN."""
    module = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return f"{module} required username={_quoted(username)} password={_quoted(password)};"


@dataclass(frozen=True)
class KafkaTopic:
    servers: str
    topic: str
    # The whole topic; the first start of a checkpoint decides.
    starting_offsets: str = "earliest"
    security_protocol: str | None = None
    sasl_mechanism: str | None = None
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    # Bounds a micro-batch, and with it what one task of the deduplication may receive.
    max_offsets_per_trigger: int | None = None
    # More read tasks than topic partitions.
    min_partitions: int | None = None
    # Further client settings, such as kafka.compression.type, for reader and writer.
    options: dict[str, str] = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        """Options that reader and writer share. A user logs in over SASL_SSL with PLAIN unless the
        topic says otherwise; without a user the client's own defaults hold."""
        login = self.username is not None
        chosen = dict(self.options) | {
            "kafka.bootstrap.servers": self.servers,
            "kafka.security.protocol": self.security_protocol or ("SASL_SSL" if login else None),
            "kafka.sasl.mechanism": self.sasl_mechanism or ("PLAIN" if login else None),
        }
        if self.username is not None:
            chosen["kafka.sasl.jaas.config"] = plain_login(self.username, self.password or "")
        return {k: v for k, v in chosen.items() if v is not None}

    def reader(self) -> dict[str, str]:
        chosen = self.connection() | {
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": self.max_offsets_per_trigger,
            "minPartitions": self.min_partitions,
        }
        return {k: str(v) for k, v in chosen.items() if v is not None}

    def open(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.reader()).load()


@dataclass(frozen=True)
class LandingFolder:
    path: str
    max_files_per_trigger: int | None = None

    def open(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(KAFKA)
        if self.max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.parquet(self.path)


def open_stream(spark: SparkSession, source: KafkaTopic | LandingFolder) -> DataFrame:
    return source.open(spark)


def open_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Committed bronze rows as a stream, so that silver need not read the topic again."""
    return spark.readStream.schema(BRONZE).parquet(path)
