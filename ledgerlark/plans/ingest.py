"""Messages to bronze and silver; the same plan for a batch and for a stream."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.decode import decode, with_event_time
from ledgerlark.operators.dedup import FOREVER, dedup_stream, first_per_key
from ledgerlark.schema import PAYLOAD

# Event times run up to 50 minutes ahead of the clock and 5 behind, so a valid row can be
# 55 minutes behind the latest.
WATERMARK_MINUTES = 60


def to_rows(bronze: DataFrame) -> DataFrame:
    """Typed, event-timed, dated rows that have an id, repeated ones too."""
    return with_event_time(decode(bronze)).where(F.col("transaction_id").isNotNull())


def earliest(rows: DataFrame) -> DataFrame:
    """The earliest arrival of each id, then any fixed order, so that a rerun keeps the same row."""
    others = [c for c in PAYLOAD if c != "transaction_id"]
    return first_per_key(rows, "transaction_id", ["kafka_ts", *others])


def to_silver(
    bronze: DataFrame,
    watermark_minutes: int = WATERMARK_MINUTES,
    mode: str = FOREVER,
    keep_bad: bool = False,
) -> DataFrame:
    """Typed, event-timed, dated rows, one per transaction id.

    Rows without an id all share the NULL key, of which one would survive; they belong into
    ``operators.decode.undecodable`` and are left out here. ``keep_bad`` keeps that one row.
    """
    rows = with_event_time(decode(bronze)) if keep_bad else to_rows(bronze)
    if bronze.isStreaming:
        return dedup_stream(rows, "transaction_id", "event_time", watermark_minutes, mode)
    return earliest(rows)
