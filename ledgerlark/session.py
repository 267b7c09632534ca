"""Session settings the operators rely on."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Hours, weekdays and dates follow the session zone; the wire format is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def job_session(app_name: str, **settings: str) -> SparkSession:
    spark = use_utc(SparkSession.builder.appName(app_name).getOrCreate())
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    There is no fallback: a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table below the shared folder, so that several passes compute them
    once and a lost executor does not compute them again."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_stored(spark: SparkSession, path: str) -> None:
    """Deletes a table that ``fresh_dir`` named and that nothing reads any more."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative training cuts its lineage through the context's checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
