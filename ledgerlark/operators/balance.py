"""Label preparation and class imbalance."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.time import epoch_seconds


def with_label(df: DataFrame, source: str = "is_fraud") -> DataFrame:
    """Rows that carry a label, with it as a double."""
    return df.dropna(subset=[source]).withColumn("label", F.col(source).cast("double"))


def with_event_seconds(df: DataFrame, source: str = "event_ts") -> DataFrame:
    """Adds ``event_ts_unix``, if the frame has an event time."""
    if source not in df.columns:
        return df
    return df.withColumn("event_ts_unix", epoch_seconds(df, source).cast("double"))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: label sums ``pos`` and ``neg``, 0 for an empty frame."""
    return df.agg(
        F.coalesce(F.sum(label), F.lit(0.0)).alias("pos"),
        F.coalesce(F.sum(1 - F.col(label)), F.lit(0.0)).alias("neg"),
    )


def scale_pos_weight() -> Column:
    """Weight of a positive over a ``class_balance`` frame: neg / pos, at least 1."""
    ratio = F.try_divide("neg", "pos")
    return F.when(F.col("pos") <= 0, 1.0).otherwise(F.greatest(F.lit(1.0), ratio))


def positive_weight(df: DataFrame, label: str = "label") -> float:
    return class_balance(df, label).select(scale_pos_weight()).head()[0]
