"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import stored


def components(links: DataFrame) -> DataFrame:
    """Rows ``v``, ``c``: every vertex of the links (``a``, ``b``) and the smallest vertex it reaches.

    In each round a vertex takes the smallest label among its neighbours', and then the label of its
    label; rounds end when no label changes. Every round is a written table, so lineage stays short.
    Partial minima are taken before the shuffle, so a vertex with very many links is no burden.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "cc")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("n"))
        lower = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "n").alias("c"))
        above = labels.select(F.col("v").alias("c"), F.col("c").alias("top"))
        jumped = lower.join(above, "c", "left").select("v", "old", F.least("c", F.coalesce("top", "c")).alias("c"))
        new = stored(jumped, "cc")
        changed = new.filter("c < old").limit(1).count()
        labels = new.select("v", "c")
        if not changed:
            return labels
