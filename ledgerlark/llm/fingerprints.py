"""Document fingerprints by winnowing.

A text is read as tokens: words, cut every 16 characters. Every k consecutive tokens have a hash; of
every w consecutive hashes the smallest is kept, of equal ones the rightmost. Kept hashes carry the
position of their first token. Two texts that share k + w - 1 consecutive tokens share a kept hash; a
run shorter than k shares none. A text of fewer than k tokens has one hash of all its tokens, a text of
fewer than w hashes one window of all of them, a text without tokens an empty fingerprint.

Position i is the choice of some window exactly if the hashes just before it that are not smaller and
the hashes just after it that are larger make up, together with itself, at least a window. So no window
is ever built.

Defined results: a null text counts as empty. Two empty fingerprints are alike (1), an empty and another
one are not (0). Equal texts have equal fingerprints, whatever else the rows hold. An empty table gives
an empty table.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.expressions import let
from ledgerlark.llm.ranges import with_ranges

TOKEN = r"[^\x20\x09-\x0D]{1,16}"
GRAM = 3
WINDOW = 5
#: Rows that one range of ids has on average.
RANGE_ROWS = 1000


def _gram_hashes(text: Column, k: int) -> Column:
    def grams(hashes: Column) -> Column:
        rolled = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]),
        )
        none = F.array().cast("array<bigint>")
        whole = F.array(F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: F.xxhash64(a, h)))
        return F.when(F.size(hashes) >= k, rolled).when(F.size(hashes) > 0, whole).otherwise(none)

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 0)
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), grams)


def _run(grams: Column, i: Column, here: Column, w: int, step: int) -> Column:
    """How many hashes in a row, at most w - 1, stand behind ``here`` in one direction."""

    def beyond(j: int) -> Column:
        there = F.get(grams, i + step * j)
        return there >= here if step < 0 else there > here

    more = F.lit(0)
    for j in range(w - 1, 0, -1):
        more = F.when(beyond(j), more + 1).otherwise(0)
    return more


def winnow(text: Column, k: int = GRAM, w: int = WINDOW) -> Column:
    """The fingerprint: an array of structs ``pos`` (of the first token) and ``hash``, by position."""

    def chosen(grams: Column) -> Column:
        marked = F.transform(grams, lambda h, i: F.struct(i.alias("pos"), h.alias("hash")))

        def keep(x: Column, i: Column) -> Column:
            spread = _run(grams, i, x["hash"], w, -1) + _run(grams, i, x["hash"], w, 1) + 1
            return spread >= F.least(F.lit(w), F.size(grams))

        return F.filter(marked, keep)

    return let(_gram_hashes(text, k), chosen)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two fingerprints' hashes, 0 to 1."""
    hashes = (F.array_distinct(x["hash"]) for x in (a, b))

    def ratio(both: Column) -> Column:
        shared = F.size(F.array_intersect(both["a"], both["b"]))
        either = F.size(both["a"]) + F.size(both["b"]) - shared
        return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)

    return let(F.struct(*[h.alias(n) for h, n in zip(hashes, "ab")]), ratio)


def digest(fingerprint: Column) -> Column:
    """The fingerprint's hashes in order of position, as text of eight hex digits each."""
    return F.array_join(F.transform(fingerprint["hash"], lambda h: F.right(F.hex(h), F.lit(8))), " ")


def with_next(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows ``doc_id``, ``text``, ``next_text``, ``fp`` and ``next_fp``; next is the row that follows in
    descending doc_id, the first for the last. Null ids come last; rows of one id follow each other by
    the hash of their text.

    Ids are cut into ranges by approximate quantiles. Each range also gets the first row of the range
    that follows it, so every row finds its successor in its own range; texts are shuffled once.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumn("_tie", F.xxhash64("text"))
    ranged = with_ranges(rows, docs, doc_id, RANGE_ROWS)
    heads = ranged.groupBy("_range").agg(F.max(F.struct("doc_id", "_tie")).alias("_head"))
    # One row per range, of which there is a bounded number: ordered in one task, sent to all.
    down = Window.orderBy(F.desc("_range"))
    to = F.coalesce(F.lag("_range").over(down), F.min("_range").over(Window.partitionBy()))
    heads = heads.select("_range", F.col("_head.doc_id").alias("_id"), F.col("_head._tie").alias("_tie"), to.alias("_to"))
    same = [ranged["_range"] == heads["_range"], ranged["doc_id"].eqNullSafe(heads["_id"]), ranged["_tie"] == heads["_tie"]]
    guests = ranged.join(F.broadcast(heads), same).select(
        ranged["doc_id"], ranged["text"], ranged["_tie"], F.col("_to").alias("_range"), F.lit(1).alias("_guest")
    )
    guests = guests.dropDuplicates(["_range"])
    dealt = ranged.withColumn("_guest", F.lit(0)).unionByName(guests).repartition("_range")
    order = Window.partitionBy("_range").orderBy("_guest", F.desc_nulls_last("doc_id"), F.desc("_tie"))
    printed = dealt.withColumn("fp", winnow(F.col("text")))
    led = printed.withColumns({"next_text": F.lead("text").over(order), "next_fp": F.lead("fp").over(order)})
    return led.filter("_guest = 0").select("doc_id", "text", "next_text", "fp", "next_fp")


def edited(text: Column, next_text: Column) -> Column:
    """The text whose last third is replaced by the beginning of the next one."""
    tail = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.char_length(text) - tail), F.substring(next_text, F.lit(1), tail)
    )
