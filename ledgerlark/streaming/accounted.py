"""Silver whose memory is a table: no state, no id comes back, and every micro-batch leaves an account.

Each micro-batch n writes three parts, in this order, below folders of its own:

* ``<path>/batch=n/event_date=...``: the rows it adds to silver,
* ``<path>-ids/batch=n``: their ids,
* ``<path>-account/batch=n``: one row with what came, what was late, what was repeated and what was kept.

It compares with the ids of the batches before it only and overwrites its own parts, so a batch that runs
again after a failure gives the same. Its account comes last: readers take batches that have one.

Of the ids only those that the batch asks for leave their scan, so the table is never shuffled while the
ids of a batch are small enough to be broadcast (Spark's threshold, checked at run time); beyond that both
sides are. Nothing is kept in memory between batches, and ids are remembered for ever.

A row is late if its event time is at or before the watermark, which is that many minutes behind the latest
event time of the batches before, late and repeated rows included. Rows without an event time are never
late. Of rows with one id in a batch the earliest arrival is kept.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.plans.ingest import WATERMARK_MINUTES, earliest, to_rows

KEY = "transaction_id"
_ACCOUNT = "rows long, late long, repeated long, kept long, latest timestamp"


def _part(path: str, what: str, batch: int) -> str:
    return f"{path}{what}/batch={batch}"


def write_batch(bronze: DataFrame, batch: int, path: str, watermark_minutes: int) -> None:
    """One micro-batch of bronze rows; safe to run again."""
    spark = bronze.sparkSession
    before = None
    if batch:
        before = spark.read.schema(_ACCOUNT).parquet(_part(path, "-account", batch - 1)).head()["latest"]
    rows = to_rows(bronze)
    mark = F.lit(before).cast("timestamp") - F.make_dt_interval(mins=F.lit(watermark_minutes))
    late = F.coalesce(F.col("event_time") <= mark, F.lit(False))
    silver = earliest(rows.where(~late))
    if batch:
        known = spark.read.schema(f"{KEY} string, batch int").parquet(f"{path}-ids").where(F.col("batch") < batch)
        asked = known.join(silver.select(KEY), KEY, "left_semi").select(KEY)
        silver = silver.join(asked, KEY, "left_anti")
    silver.write.mode("overwrite").partitionBy("event_date").parquet(_part(path, "", batch))
    kept = spark.read.schema(silver.schema).parquet(_part(path, "", batch)).select(KEY)
    kept.write.mode("overwrite").parquet(_part(path, "-ids", batch))
    came = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(late).alias("late"),
        F.greatest(F.date_trunc("millisecond", F.max("event_time")), F.lit(before).cast("timestamp")).alias("latest"),
    )
    stands = spark.read.schema(f"{KEY} string").parquet(_part(path, "-ids", batch)).agg(F.count(F.lit(1)).alias("kept"))
    account = came.crossJoin(stands).select("rows", "late", (F.col("rows") - F.col("late") - F.col("kept")).alias("repeated"), "kept", "latest")
    account.coalesce(1).write.mode("overwrite").parquet(_part(path, "-account", batch))


def start_accounted(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    watermark_minutes: int = WATERMARK_MINUTES,
    drain: bool = False,
) -> StreamingQuery:
    def write(rows: DataFrame, batch: int) -> None:
        write_batch(rows, batch, path, watermark_minutes)

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def scan_account(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished micro-batch: ``batch``, ``rows`` with an id, ``late``, ``repeated``, ``kept``
    and ``latest``, the latest event time so far."""
    return spark.read.schema(f"{_ACCOUNT}, batch int").parquet(f"{path}-account")


def scan_accounted(spark: SparkSession, path: str) -> DataFrame:
    """The silver rows of finished micro-batches, with ``batch`` and ``event_date`` as partitions."""
    last = scan_account(spark, path).agg(F.max("batch")).head()[0]
    return spark.read.parquet(path).where(F.col("batch") <= F.lit(last))
