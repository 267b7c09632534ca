"""Time expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


#: A full date and time of day; the zone may be left out and is then the session's.
DATE_TIME = r"\A\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})?\z"


def parse_timestamp(text: Column) -> Column:
    """Full date-time text to timestamp; NULL for anything else, also under ANSI.

    Spark alone would also read a bare year, and a bare time as of today.
    """
    return F.when(text.rlike(DATE_TIME), F.try_to_timestamp(text))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """A timestamp from a column that holds text or already a timestamp."""
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, TimestampType):
        return col
    if isinstance(kind, TimestampNTZType):
        return col.cast("timestamp")
    return parse_timestamp(col.cast("string"))


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970, fraction dropped."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.unix_timestamp(name)
    return F.col(name).cast("long")


def with_time_parts(df: DataFrame, name: str = "event_ts") -> DataFrame:
    """Adds ``hour`` (0-23) and ``dayofweek`` (1 = Sunday ... 7 = Saturday)."""
    return df.withColumns({"hour": F.hour(name), "dayofweek": F.dayofweek(name)})
