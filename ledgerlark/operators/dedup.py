"""One row per transaction id."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "forever"
WATERMARK = "watermark"
#: Not by state but by a table of ids, see ``streaming.accounted``.
TABLE = "table"


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only the first row per key on the map side (WindowGroupLimit) before it
    shuffles, so a key with very many copies sends one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_stream(
    df: DataFrame, key: str, event_time: str, delay_minutes: int, mode: str = FOREVER
) -> DataFrame:
    """Drops rows later than the watermark and repeated keys.

    ``forever`` remembers every key, so its state grows with the number of keys. ``watermark``
    forgets a key once the watermark passes its expiry; the key may then come back.
    """
    if mode not in (FOREVER, WATERMARK):
        raise ValueError(f"dedup mode is {FOREVER!r} or {WATERMARK!r}, not {mode!r}")
    marked = df.withWatermark(event_time, f"{delay_minutes} minutes")
    if mode == WATERMARK:
        return marked.dropDuplicatesWithinWatermark([key])
    return marked.dropDuplicates([key])
