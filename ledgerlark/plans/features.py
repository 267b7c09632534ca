"""Silver rows to the feature table."""

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.time import as_timestamp, epoch_seconds, with_time_parts
from ledgerlark.operators.rolling import BY_ROW, SPANS, add_rolling
from ledgerlark.schema import FEATURES
from ledgerlark.sinks.tables import write_run
from ledgerlark.sources.tables import scan_silver


def keep_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that the frame has, in the listed order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def feature_columns(spans: dict[str, int]) -> list[str]:
    """The fixed feature columns with one rolling triple per span."""
    if spans == SPANS:
        return FEATURES
    fixed = [c for c in FEATURES if not c.startswith("u_")]
    rolled = [f"u_{m}_{s}" for s in spans for m in ("txn_cnt", "amt_sum", "amt_avg")]
    return fixed[:-1] + rolled + fixed[-1:]


def build_features(
    df: DataFrame,
    spans: dict[str, int] | None = None,
    method: str = BY_ROW,
    dates: tuple[dt.date, dt.date] | None = None,
    **rolling,
) -> DataFrame:
    """Time parts and rolling aggregates per user.

    ``dates`` restricts what is emitted, after the frames have seen the rows before it.
    """
    spans = SPANS if spans is None else spans
    timed = df.withColumn("event_ts", as_timestamp(df, "timestamp"))
    # Only what is kept travels through the shuffle.
    slim = keep_existing(timed, FEATURES)
    parts = with_time_parts(slim)
    parts = parts.withColumn("_second", epoch_seconds(parts, "event_ts"))
    rolled = add_rolling(parts, second="_second", spans=spans, method=method, **rolling)
    if dates is not None:
        first, last = dates
        rolled = rolled.where(F.to_date("event_ts").between(F.lit(first), F.lit(last)))
    return keep_existing(rolled, feature_columns(spans))


def run(
    spark: SparkSession,
    silver: str,
    output: str,
    run_date: str | None = None,
    dates: tuple[dt.date, dt.date] | None = None,
    files: int | None = None,
    spans: dict[str, int] | None = None,
    method: str = BY_ROW,
) -> str:
    """Reads silver, writes ``<output>/date=<run_date>`` and returns that path.

    With ``dates`` only those partitions and the days that their frames reach back are read.
    """
    spans = SPANS if spans is None else spans
    read = None
    if dates is not None:
        back = dt.timedelta(days=math.ceil(max(spans.values()) / 86400))
        read = (dates[0] - back, dates[1])
    rows = scan_silver(spark, silver, read)
    return write_run(build_features(rows, spans, method, dates), output, run_date, files)
