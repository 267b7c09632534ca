"""Cutting a table into ranges of an id, without a global sort."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most ranges there are: the driver holds so many cuts at most.
MAX_RANGES = 100_000


def with_ranges(df: DataFrame, of: DataFrame, doc_id: str, rows: int, name: str = "_range") -> DataFrame:
    """Adds the number of the row's range, ascending with ``doc_id``; null ids are in range 0.

    The cuts are approximate quantiles of the ids of ``of``, such that a range has about ``rows`` rows.
    Equal ids share a range, so ids that repeat often make larger ranges.
    """
    ranges = min(MAX_RANGES, of.count() // rows + 1)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(of.approxQuantile(doc_id, shares, 1 / (4 * ranges)))) if shares else []
    value = F.coalesce(F.col(doc_id).cast("double"), F.lit(float("-inf")))
    cut = Bucketizer(
        splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="_value", outputCol="_range_found"
    )
    found = cut.transform(df.withColumn("_value", value))
    return found.withColumn(name, F.col("_range_found").cast("int")).drop("_value", "_range_found")
