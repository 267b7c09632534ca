"""Continuous ingest: a stream of messages into bronze and silver Parquet tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerlark.operators.decode import to_bronze, undecodable
from ledgerlark.operators.dedup import FOREVER, TABLE
from ledgerlark.plans.ingest import WATERMARK_MINUTES, to_silver
from ledgerlark.sources.streams import KafkaTopic, LandingFolder, open_bronze, open_stream
from ledgerlark.streaming.accounted import start_accounted

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure_state(spark: SparkSession, partitions: int | None = None) -> None:
    """State outside the JVM heap, with changelog commits.

    ``partitions`` becomes the number of state partitions. A checkpoint fixes it at its first
    start, so choose it for the number of ids to come.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    if partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


def append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    drain: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Starts an append-only Parquet sink. ``drain`` stops after what is available now."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if drain:
        writer = writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_bronze(messages: DataFrame, path: str, checkpoint: str, drain: bool = False):
    return append(to_bronze(messages), path, checkpoint, drain=drain)


def start_silver(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    watermark_minutes: int = WATERMARK_MINUTES,
    mode: str = FOREVER,
    keep_bad: bool = False,
    drain: bool = False,
):
    """``mode`` "table" keeps no state and writes an account of every micro-batch."""
    if mode == TABLE:
        if keep_bad:
            raise ValueError("a table of ids has no place for rows without one")
        return start_accounted(bronze, path, checkpoint, watermark_minutes, drain)
    silver = to_silver(bronze, watermark_minutes, mode, keep_bad)
    return append(silver, path, checkpoint, partition_by="event_date", drain=drain)


def start_quarantine(bronze: DataFrame, path: str, checkpoint: str, drain: bool = False):
    return append(undecodable(bronze), path, checkpoint, drain=drain)


def start_ingest(
    spark: SparkSession,
    source: KafkaTopic | LandingFolder,
    tables: str,
    checkpoints: str,
    watermark_minutes: int = WATERMARK_MINUTES,
    mode: str = FOREVER,
    keep_bad: bool = False,
    silver_from_bronze: bool = True,
    quarantine: bool = True,
    drain: bool = False,
) -> list[StreamingQuery]:
    """Independent queries below ``tables`` and ``checkpoints``: bronze, silver and, for what
    cannot be decoded, quarantine.

    Each recovers on its own. The topic is read once, by bronze; the others follow the committed
    bronze files, so that all of them see the same messages. A drain takes bronze to its end first.
    Without ``silver_from_bronze`` each query reads the topic from its own starting point.
    """
    messages = open_stream(spark, source)
    bronze_query = start_bronze(messages, f"{tables}/bronze", f"{checkpoints}/bronze", drain)
    if silver_from_bronze:
        if drain:
            bronze_query.awaitTermination()
        bronze = open_bronze(spark, f"{tables}/bronze")
    else:
        bronze = to_bronze(messages)
    queries = [
        bronze_query,
        start_silver(
            bronze,
            f"{tables}/silver",
            f"{checkpoints}/silver",
            watermark_minutes,
            mode,
            keep_bad,
            drain,
        ),
    ]
    if quarantine and not keep_bad:
        queries.append(
            start_quarantine(bronze, f"{tables}/quarantine", f"{checkpoints}/quarantine", drain)
        )
    return queries


def wait(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Blocks until any query ends; raises what it failed with."""
    return spark.streams.awaitAnyTermination(timeout)


class LateRows(StreamingQueryListener):
    """Counts the rows that fell behind the watermark, for every query of the session.

    Spark keeps the last progress reports only; a listener sees each of them once.
    """

    def __init__(self):
        self._dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self._dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        query = str(event.progress.id)
        self._dropped[query] = self._dropped.get(query, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def dropped(self, query: StreamingQuery) -> int:
        """Over all runs of the query since the listener was added."""
        return self._dropped.get(str(query.id), 0)


def count_late_rows(spark: SparkSession) -> LateRows:
    """Adds the listener; do so before the queries start."""
    late = LateRows()
    spark.streams.addListener(late)
    return late
