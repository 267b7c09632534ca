"""Train / test splits as a ``part`` column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.draws import bits32

TRAIN, TEST = "train", "test"
_HASHES = 1 << 32


def _part(is_train: Column) -> Column:
    return F.when(is_train, F.lit(TRAIN)).otherwise(F.lit(TEST))


def split_hash(df: DataFrame, share: float = 0.8, key: str = "transaction_id") -> DataFrame:
    """By a hash of the key: the same rows on every run, whatever the partitioning."""
    bits = bits32(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return df.withColumn("part", _part(bits < F.lit(round(share * _HASHES))))


def split_time(df: DataFrame, share: float = 0.8, at: str = "event_ts") -> DataFrame:
    """The first ``share`` of the covered time span trains, so that no test row is earlier than a
    training row. Rows without a time train."""
    seconds = F.col(at).cast("timestamp").cast("double")
    first, last = df.agg(F.min(seconds), F.max(seconds)).head()
    if first is None:
        return df.withColumn("part", F.lit(TRAIN))
    cutoff = first + share * (last - first)
    return df.withColumn("part", _part(F.coalesce(seconds <= F.lit(cutoff), F.lit(True))))


def split(df: DataFrame, how: str, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test). A random split depends on how the input is partitioned."""
    if how == "hash":
        marked = split_hash(df, share)
    elif how == "time":
        marked = split_time(df, share)
    elif how == "random":
        train, test = df.randomSplit([share, 1 - share], seed=seed)
        return train, test
    else:
        raise ValueError(f"split is 'hash', 'time' or 'random', not {how!r}")
    return tuple(marked.where(F.col("part") == p).drop("part") for p in (TRAIN, TEST))
