"""Batch scans."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_silver(
    spark: SparkSession, root: str, dates: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """The silver table, optionally restricted to an inclusive range of event dates.

    The root is read, not a glob over its partitions: that keeps ``event_date``, prunes
    partitions, and honours the streaming sink's commit log. A range also leaves out the rows
    without an event date.
    """
    silver = spark.read.parquet(root)
    if dates is None:
        return silver
    first, last = dates
    return silver.where(F.col("event_date").between(F.lit(first), F.lit(last)))


def scan_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
