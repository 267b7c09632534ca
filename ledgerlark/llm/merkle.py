"""Merkle manifest of a table: every row a leaf, a tree per source, a tree over the sources' roots.

A leaf's place is a rank query. The ids of a source form a bitmap of 64-bit words of which only those with
a bit are kept; tasks build words of their own rows and equal words are merged by OR. A directory of counts,
by 2^18, 2^30, 2^42 and 2^54 ids, says how many leaves lie before a word, and the popcount of the lower bits
says how many lie before the leaf in its word. No leaf is sorted, and no task holds a whole source.

Places then key slots: 3^6 neighbouring nodes form one slot array, which a task reduces by six levels at
once. A billion leaves take four rounds up. The same rounds go down again and hand every node the siblings
on its way to the root, so a proof's upper part is moved once for 3^6 leaves.

Defined results: a row's digest covers ``FIELDS``, null being ``-``. Null ids come first in their source,
null sources before all others. Rows of one id are ordered by their digests; repeated rows each have a leaf
and a place of their own. Words in which an id repeats, and null ids, are ranked by count instead of by
popcount, spread over 4096 buckets of the digest, so one id with very many rows is no burden either. A
source with one leaf has that leaf as its root. Empty and very long texts are hashed whole. An empty table
gives an empty table. Columns beyond ``FIELDS`` are ignored, whatever their names.
"""

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN, DEEP = 3, 6
WIDE = RUN**DEEP
#: A word of the bitmap holds 2^6 ids; each directory sums up 2^12 entries of the one below.
WORD_BITS, STEP_BITS, DIRECTORIES = 6, 12, 4
COPIES_AT_ONCE = 10_000


def digest(*values: Column) -> Column:
    """SHA-256 of the values; each is ``-`` if null, else its size in bytes, a colon and its text."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def row_digest(text: Column | None = None) -> Column:
    """The digest of a row, or of the row with another text."""
    return digest(*[text if text is not None and c == "text" else F.col(c) for c in FIELDS])


def _counted(words: DataFrame) -> DataFrame:
    """Rows ``s``, ``w``, ``bits``, ``total`` with ``base``: how many leaves of the source lie before the word."""
    levels = [words.select("s", F.col("w").alias("k"), "total")]
    for _ in range(DIRECTORIES):
        above = F.shiftright("k", STEP_BITS).alias("k")
        levels.append(levels[-1].groupBy("s", above).agg(F.sum("total").alias("total")))
    base = None
    for level in reversed(levels):
        group = ["s"] if base is None else ["s", F.shiftright("k", STEP_BITS)]
        up_to = Window.partitionBy(*group).orderBy(F.col("k").asc_nulls_first())
        placed = level.select("s", "k", (F.sum("total").over(up_to) - F.col("total")).alias("base"))
        if base is not None:
            top = base.select(F.col("s").alias("_s"), F.col("k").alias("_k"), F.col("base").alias("_base"))
            same = (F.col("s") == F.col("_s")) & F.shiftright("k", STEP_BITS).eqNullSafe(F.col("_k"))
            placed = placed.join(top, same).select("s", "k", (F.col("base") + F.col("_base")).alias("base"))
        base = placed
    base = base.select(F.col("s").alias("_s"), F.col("k").alias("_k"), "base")
    return words.join(base, (F.col("s") == F.col("_s")) & F.col("w").eqNullSafe(F.col("_k"))).drop("_s", "_k")


def _tied(rows: DataFrame) -> DataFrame:
    """Places of rows whose word holds an id more than once, or that have no id."""
    group = ["s", "w", "doc_id"]
    kept = rows.groupBy(*group, "source", "h", "other", "base").agg(F.count(F.lit(1)).alias("copies"))
    kept = kept.withColumn("bucket", F.substring("h", 1, 3))
    buckets = kept.groupBy(*group, "bucket").agg(F.sum("copies").alias("n"))
    ids = buckets.groupBy(*group).agg(F.sum("n").alias("n"))
    of_word = Window.partitionBy("s", "w").orderBy("doc_id")
    ids = ids.select(*[F.col(c).alias(f"_{c}") for c in group], (F.sum("n").over(of_word) - F.col("n")).alias("before_id"))
    same = (F.col("s") == F.col("_s")) & F.col("w").eqNullSafe(F.col("_w")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    of_id = Window.partitionBy(*group).orderBy("bucket")
    buckets = buckets.withColumn("before", F.sum("n").over(of_id) - F.col("n")).join(ids, same)
    buckets = buckets.select("_s", "_w", "_doc_id", F.col("bucket").alias("_bucket"), (F.col("before") + F.col("before_id")).alias("before"))
    of_bucket = Window.partitionBy(*group, "bucket").orderBy("h", F.col("other").asc_nulls_first())
    kept = kept.withColumn("among", F.sum("copies").over(of_bucket) - F.col("copies"))
    placed = kept.join(buckets, same & (F.col("bucket") == F.col("_bucket")))
    place = F.col("base") + F.col("before") + F.col("among")
    chunks = placed.select("s", "doc_id", "source", "h", "other", place.alias("first"), "copies",
                           F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES_AT_ONCE))).alias("chunk"))
    last = F.least(F.col("copies"), F.col("chunk") + COPIES_AT_ONCE) - 1
    each = chunks.repartition("s", "h", "chunk").withColumn("n", F.explode(F.sequence(F.col("chunk"), last)))
    return each.select("s", "doc_id", "source", "h", "other", (F.col("first") + F.col("n")).alias("place"))


def places(leaves: DataFrame) -> DataFrame:
    """Rows ``s``, ``doc_id``, ``source``, ``h``, ``other`` with ``place``, from 0, in the source."""
    leaves = leaves.withColumn("w", F.shiftright("doc_id", WORD_BITS))
    bit = F.col("doc_id").bitwiseAND(F.lit(63)).cast("int")
    words = leaves.groupBy("s", "w").agg(F.bit_or(F.expr("shiftleft(1L, cast(doc_id & 63 as int))")).alias("bits"), F.count(F.lit(1)).alias("total"))
    counted = _counted(words).select(F.col("s").alias("_s"), F.col("w").alias("_w"), "bits", "total", "base")
    found = leaves.join(counted, (F.col("s") == F.col("_s")) & F.col("w").eqNullSafe(F.col("_w")))
    plain = F.coalesce(F.col("total") == F.bit_count("bits"), F.lit(False))
    lower = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))))
    ranked = found.filter(plain).select("s", "doc_id", "source", "h", "other", (F.col("base") + lower).alias("place"))
    return ranked.union(_tied(found.filter(~plain)).select(ranked.columns))


def _reduced(slots: list[int], hashes: list[str], block: int) -> list[list[str]]:
    """The levels of a slot array, from its nodes up to the one node that it becomes."""
    levels = [[""] * len(hashes)]
    for slot, h in zip(slots, hashes):
        levels[0][slot] = h
    # Only a source's sole array ends early; all others are six levels deep, full or not.
    sole = block == 0 and len(hashes) < WIDE
    while len(levels[-1]) > 1 if sole else len(levels) <= DEEP:
        now = levels[-1]
        levels.append([sha256("".join(now[x : x + RUN]).encode()).hexdigest() for x in range(0, len(now), RUN)])
    return levels


def _siblings(levels: list[list[str]]) -> list[list[str]]:
    """Of every slot: what stands left and right of it or its node above in a run, level by level."""
    paths: list[list[str]] = [[] for _ in levels[0]]
    for deep, now in enumerate(levels[:-1]):
        sides = [("".join(now[x - x % RUN : x]), "".join(now[x + 1 : x - x % RUN + RUN])) for x in range(len(now))]
        for slot, path in enumerate(paths):
            path.extend(sides[slot // RUN**deep])
    return paths


def _slot_arrays(nodes: DataFrame, *carried: str) -> DataFrame:
    """Nodes ``s``, ``place``, ``h`` as a row for each 3^6 neighbours."""
    block = F.floor(F.col("place") / F.lit(WIDE)).cast("long").alias("block")
    kid = F.struct(F.pmod("place", F.lit(WIDE)).cast("int").alias("slot"), "h", *carried)
    return nodes.groupBy("s", block).agg(F.collect_list(kid).alias("kids"))


def _nodes_above(arrays: DataFrame) -> DataFrame:
    """The node that each slot array becomes."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            kids = batch.column("kids")
            tops = []
            for at, block in enumerate(blocks):
                own = kids[at].values
                tops.append(_reduced(own.field("slot").to_pylist(), own.field("h").to_pylist(), block)[-1][0])
            yield pa.RecordBatch.from_arrays([batch.column("s"), batch.column("block"), pa.array(tops, pa.string())], ["s", "place", "h"])

    return arrays.mapInArrow(climb, "s string, place long, h string")


def _nodes_below(arrays: DataFrame, above: DataFrame, carried: str = "") -> DataFrame:
    """The nodes of slot arrays with their ``path``, from the paths of the nodes above."""
    same = (arrays.s == F.col("_s")) & (arrays.block == F.col("_block"))
    tops = above.select(F.col("s").alias("_s"), F.col("place").alias("_block"), F.col("path").alias("above"), "subroot", "root")
    names = ["s", "place", "h", "path", "subroot", "root", *carried.replace(",", " ").split()[::2]]
    more = names[6:]

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row, own = batch.slice(at, 1), batch.column("kids")[at].values
                block, n = row.column("block")[0].as_py(), len(own)
                slots, hashes = own.field("slot").to_pylist(), own.field("h").to_pylist()
                paths, top = _siblings(_reduced(slots, hashes, block)), row.column("above")[0].as_py()
                same = [pa.array([row.column(c)[0].as_py()] * n, pa.string()) for c in ("s", "subroot", "root")]
                columns = [
                    same[0],
                    pa.array([block * WIDE + slot for slot in slots], pa.int64()),
                    pa.array(hashes, pa.string()),
                    pa.array([paths[slot] + top for slot in slots], pa.list_(pa.string())),
                    *same[1:],
                    *[own.field(c) for c in more],
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    joined = arrays.join(tops, same).select("s", "block", "kids", "above", "subroot", "root")
    kept = "s string, place long, h string, path array<string>, subroot string, root string"
    return joined.mapInArrow(descend, ", ".join(filter(None, (kept, carried))))


def _rounds(nodes: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of all rounds up, and the one node that each tree ends in."""
    rounds = []
    while True:
        rounds.append(stored(_slot_arrays(nodes, *(() if rounds else carried)), "merkle-slots"))
        nodes = stored(_nodes_above(rounds[-1]), "merkle-nodes")
        if nodes.filter("place > 0").isEmpty():
            return rounds, nodes


def _in_order(keys: DataFrame) -> DataFrame:
    """Distinct ``s`` with its ``place`` in ascending order: ranges are sorted each on its own."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(keys.repartitionByRange(parts, "s").withColumn("part", F.spark_partition_id()), "merkle-order")
    # One row for each range, so at most as many as there are shuffle partitions.
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("s")) - 1
    return ranges.withColumn("inside", inside).join(before, "part").withColumn("place", F.col("before") + F.col("inside")).drop("part", "before", "inside")


def manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """Rows ``doc_id``, ``source``, ``place``, ``leaf``, ``path``, ``subroot``, ``root``.

    ``path`` leads from the leaf to the root: for each level, what stands left of the node in its run and
    what stands right of it, as joined digests. ``other`` is an expression over a row of ``docs``, such as
    the digest of a copy of the row; the result has it as column ``other``.
    """
    group = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    other = F.lit(None) if other is None else other
    leaves = docs.select(
        group.alias("s"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        row_digest().alias("h"), other.cast("string").alias("other"),
    )
    placed = places(stored(leaves, "merkle-leaves"))
    rounds, roots = _rounds(placed, "doc_id", "source", "other")
    tops = _in_order(roots.select("s", "h"))
    trees, root = _rounds(tops.select(F.lit("").alias("s"), "place", "h", F.col("s").alias("group")), "group")
    none = F.array().cast("array<string>")
    path = root.select("s", "place", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    for arrays in reversed(trees[1:]):
        path = _nodes_below(arrays, path)
    path = _nodes_below(trees[0], path, "group string")
    path = path.select(F.col("group").alias("s"), F.lit(0).cast("long").alias("place"), "path", F.col("h").alias("subroot"), "root")
    for arrays in reversed(rounds[1:]):
        path = _nodes_below(arrays, path)
    found = _nodes_below(rounds[0], path, "doc_id long, source string, other string")
    return found.select("doc_id", "source", "place", F.col("h").alias("leaf"), "path", "subroot", "root", "other")


def proof_digest(path: Column) -> Column:
    """One digest of all siblings, from the leaf to the root."""
    return F.sha2(F.array_join(path, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give; it differs from the manifest's for any other leaf."""
    sides = F.sequence(F.lit(1), F.floor(F.size(path) / 2).cast("int"))
    climbed = F.aggregate(sides, leaf, lambda h, i: F.sha2(F.concat(F.element_at(path, 2 * i - 1), h, F.element_at(path, 2 * i)), 256))
    return F.when(F.size(path) == 0, leaf).otherwise(climbed)
