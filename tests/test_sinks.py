import pytest
from pyspark.sql import functions as F

from ledgerlark.sinks.tables import write_run


def test_a_failing_write_leaves_the_run_as_it_was(spark, tmp_path):
    root, good = f"{tmp_path}/features", spark.range(100)
    path = write_run(good, root, "2024-01-01")
    write_run(good.limit(7), root, "2024-01-02", files=1)
    bad = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_run(bad, root, "2024-01-01")
    assert spark.read.parquet(path).count() == 100
    counts = {str(r.date): r["count"] for r in spark.read.parquet(root).groupBy("date").count().collect()}
    assert counts == {"2024-01-01": 100, "2024-01-02": 7}


def test_a_run_may_be_derived_from_the_one_it_replaces(spark, tmp_path):
    root = f"{tmp_path}/features"
    path = write_run(spark.range(100), root, "2024-01-01")
    assert write_run(spark.read.parquet(path).where("id % 2 = 0"), root, "2024-01-01") == path
    assert spark.read.parquet(path).count() == 50
    assert not list((tmp_path / "features" / "_replaced").iterdir())
