"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of a total, but at most ``max_epochs`` times its own size; what a
capped source cannot take is shared again among the others by weight. In the final state the capped
sources are those with the smallest ratio of cap to weight, so one ordered pass over the sources finds
the level at which the rest is filled.

A source's rate is a number of whole repetitions of all its documents and a fraction. For the fraction,
documents are put in the order of a seeded hash and taken from the front until the next one would pass
the wanted words; one more document, the one whose size comes nearest to what is missing, is taken if
that lessens the miss. The order is cut into hash buckets: running sums over the buckets come first, and
only then sums over the documents of one bucket, so no task sees more than a bucket of a source however
large the source is.

Defined results: a null text has size 0. A null source is a source of its own, ordered last. Documents
of size 0 are carried with nothing taken. Repeated rows are documents in their own right; of equal rows
it does not matter which is taken. An empty table gives an empty table. Columns of the input are kept;
the operator's own columns start with ``_mix`` until they are renamed, and an input column named like a
result (``size``, ``source_size``, ``target``, ``taken``) is replaced by it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.expressions import word_count
from ledgerlark.session import stored

SEED = 20240607
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
#: Hex digits of the hash that number a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def _keyed(docs: DataFrame, size: Column, doc_id: str, source: str, seed: int) -> DataFrame:
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string")))
    name = F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))  # null is last
    return docs.withColumns({"_mix_size": size, "_mix_key": key, "_mix_source": name}).withColumn(
        "_mix_bucket", F.substring("_mix_key", 1, BUCKET_DIGITS)
    )


def water_fill(
    sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source (``_mix_source``, ``source_size``) to its ``target``.

    The windows have no partition: they order the sources, not the documents.
    """
    order = Window.orderBy("_mix_source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    capped = sources.withColumns(
        {
            "_w": weight,
            "_cap": (F.col("source_size") * max_epochs).cast("double"),
            "_all": F.sum("source_size").over(Window.partitionBy()).cast("double") * share,
        }
    )
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_mix_source")
    before = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levels = capped.withColumn("_level", (F.col("_all") - before) / rest)
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "_mix_source", "_level"))
    first = F.min(fits).over(Window.partitionBy())["_level"]
    target = F.when(first.isNull(), F.col("_cap")).otherwise(F.least("_cap", first * F.col("_w")))
    return levels.select("_mix_source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    size: Column | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target`` (words of its source that the mix wants),
    ``repeats`` (times the mix takes the document) and ``taken`` (words it takes).

    ``size`` is a column over ``docs``, the number of words of ``text`` by default.
    """
    keyed = _keyed(docs, word_count(F.col("text")) if size is None else size, doc_id, source, seed)
    cell = ["_mix_source", "_mix_bucket"]
    narrow = stored(keyed.select(F.col(doc_id).alias("_mix_id"), "_mix_size", "_mix_key", *cell), "mix")
    cells = narrow.groupBy(*cell).agg(F.sum("_mix_size").alias("_mix_cell"))
    sources = cells.groupBy("_mix_source").agg(F.sum("_mix_cell").alias("source_size"))
    filled = water_fill(sources, weights, share, max_epochs)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    rates = filled.withColumn("_mix_whole", whole).withColumn(
        "_mix_part", F.col("target") - (F.col("_mix_whole") * F.col("source_size"))
    )
    ahead = Window.partitionBy("_mix_source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_mix_ahead", F.coalesce(F.sum("_mix_cell").over(ahead), F.lit(0)))
    rates = rates.withColumnsRenamed({"source_size": "_mix_source_size", "target": "_mix_target"})
    cells = stored(cells.drop("_mix_cell").join(rates, "_mix_source"), "mix-cells")

    def placed(rows: DataFrame, row_id: str, cells: DataFrame) -> DataFrame:
        inside = Window.partitionBy(*cell).orderBy("_mix_key", row_id, "_mix_size")
        so_far = F.col("_mix_ahead") + F.sum("_mix_size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        ranked = rows.join(cells, cell).withColumns({"_mix_rank": F.row_number().over(inside), "_mix_sum": so_far})
        return ranked.withColumn("_mix_front", F.col("_mix_sum") <= F.col("_mix_part"))

    front = F.coalesce(F.sum(F.when(F.col("_mix_front"), F.col("_mix_size"))), F.lit(0))
    gaps = placed(narrow, "_mix_id", cells).groupBy("_mix_source").agg((F.first("_mix_part") - front).alias("_mix_gap"))
    with_gap = stored(cells.join(gaps, "_mix_source"), "mix-gaps")
    miss = F.abs(F.col("_mix_size") - F.col("_mix_gap"))
    spare = placed(narrow, "_mix_id", with_gap).filter(~F.col("_mix_front") & (miss < F.col("_mix_gap")))
    fill = spare.groupBy("_mix_source").agg(
        F.min(F.struct(miss.alias("miss"), "_mix_key", "_mix_bucket", "_mix_rank")).alias("_mix_best")
    )
    fill = fill.select("_mix_source", "_mix_best._mix_bucket", F.col("_mix_best._mix_rank").alias("_mix_fill"))
    chosen = placed(keyed, doc_id, cells.join(fill, cell, "left"))
    extra = F.col("_mix_front") | F.coalesce(F.col("_mix_rank") == F.col("_mix_fill"), F.lit(False))
    named = {
        "size": F.col("_mix_size"),
        "source_size": F.col("_mix_source_size"),
        "target": F.col("_mix_target"),
        "repeats": F.col("_mix_whole") + extra.cast("long"),
        "taken": F.col("_mix_size") * (F.col("_mix_whole") + extra.cast("long")),
    }
    chosen = chosen.withColumns(named)
    return chosen.drop(*[c for c in chosen.columns if c.startswith("_mix_")])
