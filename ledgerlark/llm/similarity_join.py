"""Jaccard join of documents by word n-grams, with token-combination prefixes.

A document's set holds the 64-bit hashes of its distinct shingles. All sets are put in one order, the rarest
elements first: a sketch of ``CELLS`` counters, in which every document counts its elements, gives an
element's frequency, and the hash decides among equals. Any order that is the same for all sets loses no pair;
this one keeps what many documents share out of their prefixes. If two sets of n and m elements share
enough, the first ``n - ceil(t n) + k`` elements of each (the prefix, extended by k - 1) share at least k =
``SHARED``; the smaller set's prefix needs to be no longer than ``n - ceil(2 t n / (1 + t)) + k``. How many prefixes hold an element is counted over all documents. At
an element that at most ``MANY`` hold all pairs are made, at most (``MANY`` - 1) / 2 for each of them; a pair made twice is
verified. Any other pair that is alike shares k - 1 elements of more prefixes. Of these, an element held by at most
``FREQUENT`` prefixes is indexed by itself, the others in combinations of two from one of k - 2 groups, into
which the hash deals them. So a pair of documents meets at an element of the first kind, or it shares k - 1 of the
second kind, two of them in one group, and meets at that combination. Sets so small that they may share fewer
than k are indexed with all combinations; if two may share two only, every pair made is verified.

1. Texts with equal sets form a class; joins work on classes, named by a hash of their sets.
2. At every element of more than ``MANY`` prefixes the first class is a hub. Pairs of a document and a hub, and
   pairs at the other elements, that meet at two elements or more are verified; what is linked is one component. That
   takes care of groups of copies, however large, with one pair a document. The other elements are done with. At those
   where components still meet, another class is the hub, drawn by a hash of class and element, and pairs of
   different components are verified: one pair for each such element of a document. So groups of near copies become
   one component before pairs are joined, unless they are less alike than is asked for.
3. Elements whose documents are all in one component are done. At the others, and at combinations of the
   frequent ones, the pairs from different components are the candidates. At each key the documents
   outside its largest component are joined with all, so a large group is not paired with itself.
4. Candidates pass a length filter and two bitmap filters, which lose no pair (parity bits of the sets:
   they differ in at most as many bits as the sets differ in elements): 1024 bits while keys are joined,
   then at least a bit for every second element. The rest is verified on the whole sets.

Defined results: a text of fewer words than a shingle has one shingle of all its words; a null text and one
without words have an empty set, which is linked with nothing. Every row is compared by its own text: rows of
one doc_id with different texts may be in different components, and rows with a null doc_id take part like
others. A component's id is its smallest doc_id that is not null, or null if it has none. An empty table gives
an empty table. Further columns of the input are not carried; ``row0`` and ``row1``, hashes of doc_id and text,
tell the rows apart (``row_keys``).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.components import components
from ledgerlark.llm.textbytes import WHITE, flat, grams, mixed, owner, pieces, words
from ledgerlark.session import drop_stored, fresh_dir, stored

SHINGLE = 3
PERCENT = 90
#: Elements of a combination, elements that extended prefixes share, prefixes that hold a rare element.
COMBINED, SHARED = 2, 8
FREQUENT = 64
#: Rounds of drawn hubs, and prefixes that an element is in if it gets a hub: at the others pairs are few and all made.
MORE, MANY = 1, 8
#: Ids that are sent to all tasks at most; more are joined by a shuffle.
SENT = 200_000
#: The short bitmap that travels with the keys: 1024 bits.
_MAP = [f"m{i}" for i in range(16)]
BITS = 64 * len(_MAP)
#: Counters of the sketch and how many of them travel in one piece. A counter is kept as its logarithm.
CELLS, CELLS_AT_ONCE = 1 << 20, 1 << 16


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ordered by text and then by value, and where each text's begin."""
    data, offsets = flat(texts)
    begins, _, hashes = words(data, offsets, WHITE)
    text = owner(begins, offsets)
    g = grams(hashes, width)
    whole = text[: len(g)] == text[width - 1 :] if len(g) else np.zeros(0, bool)
    count = np.bincount(text, minlength=len(texts))
    starts = np.concatenate(([0], np.cumsum(count)))
    short = np.flatnonzero((count > 0) & (count < width))
    lone = [mixed(grams(hashes[starts[i] : starts[i + 1]], int(count[i])) + np.uint64(count[i])) for i in short]
    values = np.concatenate([g[whole], *lone])
    of = np.concatenate([text[: len(g)][whole], short])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    first = np.ones(len(of), bool)
    first[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[first], of[first]
    return values, np.searchsorted(of, np.arange(len(texts) + 1))


def _bitmap(values: np.ndarray) -> bytes:
    """Parity bits of a set, at least one for every second element, in a power of two."""
    size = max(256, 1 << (max(len(values) // 2, 1) - 1).bit_length())
    cells = (values & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=size) & 1).astype(np.uint8)).tobytes()


def _differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, after the longer one is folded."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def frequencies(docs: DataFrame, width: int) -> np.ndarray:
    """A level for every counter of the sketch, higher for more frequent elements: one byte each."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(CELLS, np.int64)
        for batch in pieces(batches):
            values, _ = _sets(batch.column(0), width)
            found += np.bincount((values & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        # Counts of one task are cut at 16 bits; the sketch only orders.
        parts = np.minimum(found, 65535).astype("<u2").reshape(-1, CELLS_AT_ONCE)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[part] = found.get(part, 0) + np.frombuffer(counts, "<u2").astype(np.int64)
        levels = [np.minimum(8 * np.log2(c + 1.0), 255).astype(np.uint8).tobytes() for c in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(levels, pa.binary())], ["part", "levels"])

    counts = docs.select("text").mapInArrow(counted, "part int, counts binary")
    # One byte a counter comes to the driver, however many documents there are.
    rows = counts.repartition("part").mapInArrow(summed, "part int, levels binary").collect()
    levels = np.zeros((CELLS // CELLS_AT_ONCE, CELLS_AT_ONCE), np.uint8)
    for r in rows:
        levels[r.part] = np.frombuffer(r.levels, np.uint8)
    return levels.ravel()


def row_keys(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two hashes that tell rows with different ids or texts apart."""
    return F.xxhash64(doc_id, text).alias("row0"), F.xxhash64(text, doc_id, F.lit(1)).alias("row1")


def _classes_of(n: np.ndarray, marks: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(marks[0] + n.astype(np.uint64)) ^ marks[1]).view(np.int64)


def _marked(values: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two sums of scattered elements of every set."""
    with np.errstate(over="ignore"):
        spread = mixed(values ^ np.uint64(0x5BD1E995)), mixed(values + np.uint64(0x1B873593))
        sums = [np.concatenate(([np.uint64(0)], np.cumsum(s))) for s in spread]
        return [s[at[1:]] - s[at[:-1]] for s in sums]


def _profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: size and class of its set, the bitmap and the extended prefix."""
    levels = docs.sparkSession.sparkContext.broadcast(frequencies(docs, width))

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values, at = _sets(batch.column("text"), width)
            n, rows = np.diff(at), batch.num_rows
            of = np.repeat(np.arange(rows), n)
            classes = _classes_of(n, _marked(values, at))
            cell = of * BITS + (values & np.uint64(BITS - 1)).astype(np.int64)
            bits = np.packbits((np.bincount(cell, minlength=rows * BITS) & 1).astype(np.uint8)).view("<i8").reshape(rows, len(_MAP))
            length = n - -(-percent * n // 100) + SHARED
            level = levels.value[(values & np.uint64(CELLS - 1)).astype(np.int64)]
            rarest = values[np.lexsort((values, level, of))]
            prefixes = [rarest[a : a + min(k, m)].tobytes() for a, k, m in zip(at, length, n)]
            maps = [_bitmap(values[a:b]) for a, b in zip(at, at[1:])]
            own = [batch.column(c) for c in ("doc_id", "row0", "row1")]
            columns = [*own, pa.array(n), pa.array(classes), *(pa.array(b) for b in bits.T.copy()), pa.array(prefixes, pa.binary()), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row0", "row1", "n", "doc", *_MAP, "prefix", "map"])

    schema = "doc_id long, row0 long, row1 long, n long, doc long, " + ", ".join(f"{m} long" for m in _MAP) + ", prefix binary, map binary"
    return docs.mapInArrow(profiled, schema)


def _entries(profiles: DataFrame, percent: int) -> DataFrame:
    """One row per class and element of its extended prefix; ``early`` elements are those that a set must
    share with any that is not smaller: of two sets, the smaller one's prefix may be shorter."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "prefix"):
            found = [np.frombuffer(p, np.int64) for p in batch.column("prefix").to_pylist()]
            many, n = np.array([len(f) for f in found], int), batch.column("n").to_numpy()
            at = np.repeat(np.arange(len(many)), many)
            place = np.arange(len(at)) - np.concatenate(([0], np.cumsum(many)))[at]
            early = place < (n - -(-2 * percent * n // (100 + percent)) + SHARED)[at]
            key = np.concatenate([*found, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("doc").take(pa.array(at)), pa.array(early)], ["key", "doc", "early"])

    return profiles.select("doc", "n", "prefix").mapInArrow(listed, "key long, doc long, early boolean")


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _near_maps(x: str, y: str, percent: int) -> Column:
    differ = sum((F.bit_count(F.col(f"{x}.{m}").bitwiseXOR(F.col(f"{y}.{m}"))) for m in _MAP), F.lit(0))
    return differ * (100 + percent) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - percent)


def _restricted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is listed; a short list is sent to all tasks, a long one is joined. Rows without an
    id are read if null is listed."""
    listed, null = ids.agg(F.count("doc_id"), F.max(F.col("doc_id").isNull())).head()
    texts = docs.join(F.broadcast(ids) if listed <= SENT else ids, "doc_id", "left_semi")
    return texts.unionByName(docs.filter("doc_id is null")) if null else texts


def _verified(docs: DataFrame, pairs: DataFrame, maps: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that are alike enough, by their whole sets; ``maps`` has every class's
    ``n``, ``map`` and smallest ``doc_id``."""

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("x", "y", "k", "m")))
            near = [
                min(k, m) * 100 >= max(k, m) * percent and _differing(x, y) * (100 + percent) <= (k + m) * (100 - percent)
                for x, y, k, m in rows
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values, at = _sets(batch.column("text"), width)
            classes = _classes_of(np.diff(at), _marked(values, at))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(classes), lists], ["id", "set"])

    left = pairs.join(maps.select(F.col("doc").alias("a"), "n", *_MAP, "map"), "a").alias("x")
    right = maps.select(F.col("doc").alias("other"), "n", *_MAP, "map").alias("y")
    # Sizes and short bitmaps are compared in the join itself, so few pairs leave it.
    near = [F.col("x.b") == F.col("y.other"), _near_sizes(F.col("x.n"), F.col("y.n"), percent), _near_maps("x", "y", percent)]
    both = left.join(right, near)
    both = both.select("a", "b", F.col("x.n").alias("k"), F.col("x.map").alias("x"), F.col("y.n").alias("m"), F.col("y.map").alias("y"))
    pairs = stored(both.mapInArrow(sifted, "a long, b long"), "join-pairs")
    asked = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    ids = stored(maps.join(asked, "doc", "left_semi").select("doc_id").distinct(), "join-ids")
    # A row without an id is read if any class has no other.
    sets = _restricted(docs, ids).mapInArrow(full, "id long, set array<long>").join(asked.withColumnRenamed("doc", "id"), "id", "left_semi")
    sets = stored(sets.dropDuplicates(["id"]), "join-sets")
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
    whole = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    linked = whole.select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
    return linked.filter(F.col("both") * 100 >= (F.col("sum") - F.col("both")) * percent).select("a", "b")


def _combined(often: DataFrame, group: Column) -> DataFrame:
    """Combinations of two of a document's elements from one group, as keys."""
    one = often.select("doc", "n", "key", "early", group.alias("group"))
    two = one.select("doc", "group", F.col("key").alias("other"), F.col("early").alias("too"))
    both = one.join(two, ["doc", "group"]).filter(F.col("key") < F.col("other"))
    return both.select(F.xxhash64("key", "other", "group").alias("key"), "doc", (F.col("early") & F.col("too")).alias("early"), "n")


def _candidates(keyed: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different components (``c``) that share a key and pass both filters.

    Keys at which components meet are a table: with all of it in one plan, dozens of stages would be planned and
    run at a time, which is the driver's memory. Bitmaps join what is left.
    """
    each = keyed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size"))
    main = each.groupBy("key").agg(F.max(F.struct("size", "c"))["c"].alias("main"), F.count(F.lit(1)).alias("parts"))
    met = stored(keyed.join(main.filter("parts > 1").drop("parts"), "key"), "join-met")
    mixed_keys = met.join(described.select("doc", "n", *_MAP), "doc")
    x, y = mixed_keys.filter("c <> main").alias("x"), mixed_keys.alias("y")
    once = (F.col("x.doc") < F.col("y.doc")) | (F.col("y.c") == F.col("y.main"))
    smaller = F.struct("x.n", "x.doc") < F.struct("y.n", "y.doc")
    early = F.when(smaller, F.col("x.early")).otherwise(F.col("y.early"))
    near = [F.col("x.key") == F.col("y.key"), F.col("x.c") != F.col("y.c"), once, early, _near_sizes(F.col("x.n"), F.col("y.n"), percent), _near_maps("x", "y", percent)]
    pairs = x.join(y, near)
    return pairs.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()


def _first_pairs(shared: DataFrame, least: int) -> DataFrame:
    """Pairs that meet ``least`` times: at elements of few prefixes any two classes, at others each with the first."""
    lists = shared.filter(F.col("held") <= MANY).groupBy("key").agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    each = lists.select("docs", F.posexplode("docs").alias("at", "a"))
    few = each.select("a", F.explode(F.expr("slice(docs, at + 2, size(docs))")).alias("b"))
    hubs = shared.filter((F.col("held") > MANY) & (F.col("doc") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("doc").alias("b"))
    met = few.unionByName(hubs).groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"))
    return met.filter(F.col("met") >= least).select("a", "b")


def _still_open(entries: DataFrame, standing: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes with their components so far (``c``), and the entries at elements where two components meet."""
    found = components(links).withColumnRenamed("v", "doc")
    described = standing.select("doc", "n", *_MAP).join(found, "doc", "left").withColumn("c", F.coalesce("c", "doc"))
    open_keys = entries.join(described.select("doc", "c"), "doc").groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    still = entries.join(open_keys.filter("lo < hi").select("key"), "key").select("key", "doc", "early", "held")
    return described, stored(still, "join-open")


def _drawn_hubs(still: DataFrame, described: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of different components, of a document and the hub of an element."""
    entries = still.select("key", "doc").join(described.select("doc", "c", "n"), "doc")
    hubs = entries.groupBy("key").agg(F.min(F.struct(F.xxhash64("doc", "key", F.lit(turn)), "doc", "c", "n")).alias("hub"))
    met = entries.join(hubs, "key").filter((F.col("c") != F.col("hub.c")) & _near_sizes(F.col("n"), F.col("hub.n"), percent))
    return met.select(F.least("doc", "hub.doc").alias("a"), F.greatest("doc", "hub.doc").alias("b")).distinct()


def link(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT, doc_id: str = "doc_id") -> DataFrame:
    """Rows ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id reachable by links), ``component``
    (null for an empty set), ``row0`` and ``row1``."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), "text", *row_keys(F.col(doc_id), F.col("text")))
    profiles = stored(_profiles(docs, width, percent), "join-profiles")
    classes = profiles.filter("n > 0").groupBy("doc").agg(F.min("doc_id").alias("doc_id"))
    classes = stored(classes, "join-classes")
    # From this size on sets that are alike enough share SHARED elements.
    enough = -(-100 * SHARED // percent)
    # A smaller set is alike enough to an equal one only.
    least = -(-percent // (100 - percent)) if percent < 100 else None
    single = profiles.filter(F.col("n") >= least) if least else profiles.limit(0)
    standing = single.select("doc", "n", *_MAP, "prefix", "map").dropDuplicates(["doc"])
    standing = stored(standing.join(classes, "doc"), "join-standing")
    entries = _entries(standing, percent)
    # Which element how many prefixes hold; the first class is its hub.
    held = entries.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("doc").alias("hub"))
    path = fresh_dir(docs.sparkSession, "join-entries")
    entries.join(held.filter("held > 1"), "key").write.parquet(path)
    shared = docs.sparkSession.read.parquet(path)
    # Sets that need not share more than two elements may meet once here and share one other.
    twice = least is None or percent * least > 100 * COMBINED
    maps = standing.select("doc", "n", *_MAP, "map", "doc_id")
    links = _verified(docs, _first_pairs(shared, COMBINED if twice else 1), maps, width, percent)
    links = stored(links, "join-links")
    described, still = _still_open(shared.filter(F.col("held") > MANY), standing, links)
    # The largest of the tables; from here on only its open part is read.
    drop_stored(docs.sparkSession, path)
    for turn in range(MORE):
        if still.isEmpty():
            # No element gets a hub, so the round would plan and run some thirty jobs on empty tables.
            break
        links = stored(links.unionByName(_verified(docs, _drawn_hubs(still, described, percent, turn), maps, width, percent)), "join-links")
        # Elements do not open again.
        described, still = _still_open(still, standing, links)
    alone = still.filter(F.col("held") <= frequent).select("key", "doc", "early")
    often = still.filter(F.col("held") > frequent).select("key", "doc", "early").join(described.select("doc", "n"), "doc")
    combined = _combined(often, F.pmod("key", F.lit(SHARED - COMBINED))).filter(F.col("n") >= enough)
    # A pair with a set below that has none beyond the second bound.
    few = _combined(often.filter(F.col("n") < -(-100 * enough // percent) + 1), F.lit(-1))
    combined = combined.unionByName(few).select("key", "doc", "early")
    keyed = alone.unionByName(combined).join(described.select("doc", "c"), "doc")
    more = _verified(docs, _candidates(keyed, described, percent), maps, width, percent)
    found = components(links.unionByName(more))
    named = classes.join(found.withColumnRenamed("v", "doc"), "doc", "left").withColumn("component", F.coalesce("c", "doc"))
    least_id = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.select("doc", "component").join(least_id, "component")
    rows = profiles.select("doc_id", "row0", "row1", F.col("n").alias("n_shingles"), "doc").join(named, "doc", "left")
    lone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", lone.alias("component_id"), "component", "row0", "row1")
