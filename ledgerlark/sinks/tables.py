"""Batch sinks."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame


def utc_today() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")


def write_run(
    df: DataFrame, output: str, run_date: str | None = None, files: int | None = None
) -> str:
    """Replaces ``<output>/date=<run_date>`` and leaves the other dates alone.

    The rows are written beside the run, below ``_staged``, which readers of ``output`` skip. Only when all
    of them are there does the old run make way, by two renames; a write that fails leaves it as it was,
    and rows may be derived from the run that they replace. ``files`` forces a number of output files through
    one more shuffle; by default every task writes its own.
    """
    path = f"{output}/date={run_date or utc_today()}"
    staged, replaced = (f"{output}/{name}/{uuid.uuid4().hex}" for name in ("_staged", "_replaced"))
    if files is not None:
        df = df.repartition(files)
    df.write.parquet(staged)
    spark = df.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path, replaced)]
    new, run, old = paths
    store = run.getFileSystem(spark._jsc.hadoopConfiguration())
    had = store.exists(run)
    if had:
        store.mkdirs(old.getParent())
        _moved(store, run, old)
    _moved(store, new, run)
    if had:
        store.delete(old, True)
    return path


def _moved(store, source, target) -> None:
    if not store.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")
