"""Benchmark decontamination: rare n-grams join passages to test items, then local alignment.

A word is a run of letters (A-Z lower-cased), a run of digits, or one character of a script written
without spaces; everything else stands between words. A document is contaminated by an item if the best
Smith-Waterman alignment of the two (equal words +1, different ones -1, gap -1) reaches a least score:
``SCORE`` of the item's words, and at least three of them or all.

An alignment of score s has runs of equal words, at most one more than it has errors, so it holds at
least s - 1 of the item's pairs of neighbouring words whole. Of the item's pairs that the corpus holds
at all, the most frequent ones may therefore be left out, two fewer than the least score; the others,
the rare ones, are the item's seeds, and every alignment that counts holds one. So nothing is missed,
and what is frequent everywhere joins nothing, unless an item consists of it.

1. The pairs of all items mark the cells of a table of fixed size, which tells most pairs of the
   documents apart inside the tasks. The rest is counted over the corpus.
2. Each item ranks its pairs by that count and keeps the rare ones.
3. Rows with a seed are written to a table, all others are read no more. Occurrences of seeds join the
   items on the pair; what meets is (row, item, place in the text).
4. Rows that met an item get their items' words, in groups of at most about ``PAIRS`` items, and each
   passage is aligned with its item. A passage reaches as far as an alignment of the least score
   through the seed can, so scores are those of the whole text. Passages that hold too few of the
   item's words for that score are not aligned.

Items, documents and what they have in common stay in tables; the driver sees the table of cells only.

Defined results: null items and those of fewer than two words are not searched for, as one word tells
nothing; equal items of one id are one item. Null and empty texts match nothing. Equal rows of one id
have equal results, one each; of alignments with equal scores the first in the text counts. With an
empty table of items or documents nothing is contaminated. Ids may be null and of any type. Other
columns of the documents are kept by ``clean``, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.similarity_join import row_keys
from ledgerlark.llm.textbytes import flat, grams, owner, pieces, words
from ledgerlark.session import stored

#: Words of a seed; the bound on what an alignment holds is one for pairs.
GRAM = 2
SCORE = 0.4
#: Equal words that an alignment needs besides, or all of a shorter item.
LEAST_WORDS = 3
#: Items that one row is aligned with at a time, about.
PAIRS = 4096
#: Bits, as a power of two, of the table that tells n-grams of no item apart quickly.
SIEVE_BITS = 22
#: Cells of alignment tables that are worked on at once.
CELLS = 1 << 21


def align(items: np.ndarray, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of the rows of two padded matrices: score, begin and end in the window.

    A cell holds its score in the upper half and, for ties to prefer early ones, the complement of the
    place where its alignment begins in the lower half, so one maximum serves both.
    """
    one, low = np.int64(1) << 32, (np.int64(1) << 32) - 1
    k, w = windows.shape
    places = np.arange(w + 1, dtype=np.int64)
    fresh = np.broadcast_to(low - places, (k, w + 1))
    above, best, ends = fresh.copy(), np.full(k, low, np.int64), np.zeros(k, np.int64)
    for i in range(items.shape[1]):
        live = (i < sizes)[:, None]
        same = (windows == items[:, i : i + 1]) & live
        now = np.maximum(fresh, above - one)
        now[:, 1:] = np.maximum(now[:, 1:], above[:, :-1] + np.where(same, one, -one))
        now = np.maximum(np.maximum.accumulate(now + places * one, 1) - places * one, fresh)
        above = np.where(live, now, above)
        at = above.argmax(1)
        top = above[np.arange(k), at]
        better = (top >> 32 > best >> 32) & live[:, 0]
        best, ends = np.where(better, top, best), np.where(better, at, ends)
    return best >> 32, low - (best & low), ends


def reach(sizes: np.ndarray, least: float) -> np.ndarray:
    """Words an alignment of the least score can have beyond an item's own: each costs what an equal word gains."""
    return np.ceil((1 - least) * sizes).astype(int) + 1


def shared(items: np.ndarray, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many words of each row's item occur in its window."""
    found = np.zeros(len(items), int)
    for i in range(items.shape[1]):
        found += (windows == items[:, i : i + 1]).any(1) & (i < sizes)
    return found


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end in the text's bytes, hash and owner of every word of a batch of texts."""
    data, offsets = flat(texts)
    kind = kinds(data)
    begins, ends, hashes = words(data, offsets, kind == 0, kind)
    text = owner(begins, offsets)
    return begins - offsets[text], ends - offsets[text], hashes, text


# Fixed values, by UTF-8: lead bytes of three-byte characters of scripts written without spaces (kana and
# Han from U+3000, Thai and Lao, Myanmar, Khmer), then the second bytes that narrow them; Han beyond
# U+20000 has the lead byte F0 and the second byte A0 or more.
_ALONE = np.zeros((256, 256), bool)
for _lead, _from, _to in ((0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE3, 0x81, 0xBF), (0xF0, 0xA0, 0xAF)):
    _ALONE[_lead, _from : _to + 1] = True
_ALONE[0xE4:0xEA, 0x80:0xC0] = True
# Punctuation: U+2000 to U+206F, U+3000 to U+303F, and the wide forms U+FF00 to U+FF0F, U+FF1A to U+FF20.
_MARKS = ((0xE2, 0x80, 0x81, 0x80, 0xBF), (0xE3, 0x80, 0x80, 0x80, 0xBF), (0xEF, 0xBC, 0xBC, 0x80, 0x8F), (0xEF, 0xBC, 0xBC, 0x9A, 0xA0))


def kinds(data: np.ndarray) -> np.ndarray:
    """Per byte: 0 between words, 1 letter, 2 digit, 3 and 4 the first and later bytes of a character that
    is a word of its own."""
    kind = np.zeros(len(data), np.uint8)
    low = data | 0x20
    kind[(data >= 128) | ((low >= ord("a")) & (low <= ord("z")))] = 1
    kind[(data >= ord("0")) & (data <= ord("9"))] = 2
    if not len(data) or data.max() < 128:
        return kind
    second = np.append(data[1:], 0)
    third = np.append(data[2:], [0, 0])[: len(data)]
    for lead, a, b, c, d in _MARKS:
        at = np.flatnonzero((data == lead) & (second >= a) & (second <= b) & (third >= c) & (third <= d))
        for step in range(3):
            kind[at + step] = 0
    at = np.flatnonzero(_ALONE[data, second] & (kind == 1))
    for step, later in ((0, at), (1, at), (2, at), (3, at[data[at] == 0xF0])):
        kind[later + step] = 4 if step else 3
    return kind


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def known_items(items: DataFrame, item_id: str, least: float) -> DataFrame:
    """The items as a table: ``item`` (a key), ``item_id``, ``words`` (hashes), ``need`` (least score) and
    ``slack`` (words a passage reaches beyond an item on either side)."""
    rows = items.select(F.col(item_id).alias("item_id"), "text").filter(F.col("text").isNotNull())
    rows = rows.withColumn("item", F.md5(F.to_json(F.struct("item_id", "text")))).dropDuplicates(["item"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            _, _, hashes, text = tokens(batch.column("text"))
            split = lists(hashes, np.bincount(text, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item"), split], ["item_id", "item", "words"])

    kind = dict(rows.dtypes)["item_id"]
    size = F.size("words")
    need = F.greatest(F.ceil(size * least - 1e-9), F.least(size, F.lit(LEAST_WORDS)))
    found = rows.select("item_id", "item", "text").mapInArrow(read, f"item_id {kind}, item string, words array<long>")
    found = found.filter(size >= GRAM).withColumns({"need": need, "slack": F.ceil((1 - least) * size) + 1})
    return stored(found, "items")


def item_grams(known: DataFrame) -> DataFrame:
    """Rows ``item``, ``need``, ``slack``, ``place`` and ``gram`` of every pair of neighbouring words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("words")
            size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            whole = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            first = np.repeat(np.cumsum(size) - size, size - GRAM + 1)
            place = np.arange(len(first)) - np.repeat(np.cumsum(size - GRAM + 1) - (size - GRAM + 1), size - GRAM + 1)
            which = pa.array(np.repeat(np.arange(len(size)), size - GRAM + 1))
            gram = grams(whole, GRAM)[first + place].view(np.int64)
            rest = [batch.column(name).take(which) for name in ("item", "need", "slack")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(place), pa.array(gram)], ["item", "need", "slack", "place", "gram"])

    return known.select("item", "need", "slack", "words").mapInArrow(read, "item string, need long, slack long, place long, gram long")


class Sieve:
    """A table of fixed size that tells most n-grams apart from the given ones."""

    def __init__(self, given: DataFrame):
        cell = F.shiftrightunsigned("gram", 64 - SIEVE_BITS)
        bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
        rows = given.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
        # At most 2^(SIEVE_BITS - 6) rows, whatever the tables hold.
        self.table = np.zeros(1 << SIEVE_BITS - 6, np.int64)
        for row in rows.collect():
            self.table[row["at"]] = row["bits"]

    def places(self, hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams begin that may be given ones, and the n-grams; none spans texts."""
        g = grams(hashes, GRAM)
        cell = g >> np.uint64(64 - SIEVE_BITS)
        bits = self.table.view(np.uint64)[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))
        at = np.flatnonzero(bits & np.uint64(1))
        at = at[text[at] == text[at + GRAM - 1]]
        return at, g[at].view(np.int64)


def counts(rows: DataFrame, sieve: Sieve) -> DataFrame:
    """``gram`` and ``n``, how often the texts hold it, of all n-grams that pass the sieve."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            _, _, hashes, text = tokens(batch.column("text"))
            gram, n = np.unique(sieve.places(hashes, text)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])

    return rows.select("text").mapInArrow(read, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def seeds(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rare n-grams of every item among those that the texts hold: all but its ``need - 2`` most frequent."""
    every = stored(item_grams(known), "item-grams")
    held = every.join(counts(rows, Sieve(every)), "gram")
    often = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("n"), "gram", "place"))
    return stored(held.withColumn("often", often).filter("often > need - 2").select("gram", "item", "place", "slack"), "seeds")


def holders(rows: DataFrame, sieve: Sieve) -> DataFrame:
    """The rows with an n-gram that passes the sieve, with these: ``at`` (word numbers) and ``gram``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            _, _, hashes, text = tokens(batch.column("text"))
            at, gram = sieve.places(hashes, text)
            first = np.searchsorted(text, np.arange(batch.num_rows))
            many = np.bincount(text[at], minlength=batch.num_rows)
            with_any = pa.array(np.flatnonzero(many))
            found = [lists(values, many[many > 0]) for values in (at - first[text[at]], gram)]
            yield pa.RecordBatch.from_arrays([*batch.take(with_any).columns, *found], [*batch.schema.names, "at", "gram"])

    rows = rows.select("doc_id", "text", "row0", "row1")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(read, f"doc_id {kind}, text string, row0 long, row1 long, at array<long>, gram array<long>")


def passages(held: DataFrame, rare: DataFrame) -> DataFrame:
    """``row0``, ``row1``, ``item`` and ``starts``: where in the text, in steps of the slack, the item may begin."""
    met = held.select("row0", "row1", F.inline(F.arrays_zip("at", "gram"))).join(rare, "gram")
    start = F.floor((F.col("at") - F.col("place")) / F.col("slack"))
    return stored(met.groupBy("row0", "row1", "item").agg(F.collect_set(start).alias("starts")), "passages")


def best_alignments(texts: pa.Array, picked: pa.ListArray, least: float) -> list[tuple]:
    """(text, pick, score, begin, end in bytes) of the best alignment of each text and picked item."""
    begins, ends, hashes, text = tokens(texts)
    edge = np.searchsorted(text, np.arange(len(texts) + 1))
    picks = picked.flatten()
    of_text = np.repeat(np.arange(len(texts)), pc.list_value_length(picked).to_numpy(zero_copy_only=False))
    listed, starts = picks.field("words"), picks.field("starts")
    need = picks.field("need").to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
    item_words, item_edge = listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(sizes) - sizes
    many = pc.list_value_length(starts).to_numpy(zero_copy_only=False)
    pick, start = np.repeat(np.arange(len(picks)), many), starts.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((start, pick, sizes[pick]))
    pick, start = pick[order], start[order]
    best: dict[int, tuple] = {}
    cut = 0
    while cut < len(pick):
        step = 1
        while cut + step < len(pick) and step < 512 and (step + 1) * 3 * (sizes[pick[cut + step]] + 8) < CELLS // 64:
            step += 1
        rows, begin_step = pick[cut : cut + step], start[cut : cut + step]
        cut += step
        size, own = sizes[rows], of_text[rows]
        slack = reach(size, least)
        lo = np.maximum((begin_step - 1) * slack, 0) + edge[own]
        hi = np.maximum(np.minimum((begin_step + 2) * slack + size + edge[own], edge[own + 1]), lo)
        windows = np.zeros((len(rows), int((hi - lo).max())), np.uint64)
        items = np.ones((len(rows), int(size.max())), np.uint64)
        for k, (a, b, r) in enumerate(zip(lo, hi, rows)):
            windows[k, : b - a] = hashes[a:b]
            items[k, : size[k]] = item_words[item_edge[r] : item_edge[r] + size[k]]
        # No alignment has more equal words than the item has words that occur in the window.
        able = np.flatnonzero(shared(items, windows, size) >= need[rows])
        if not len(able):
            continue
        rows, lo, size = rows[able], lo[able], size[able]
        score, begin, end = align(items[able], windows[able], size)
        for k in np.flatnonzero(score >= need[rows]):
            a, b = lo[k] + begin[k], lo[k] + end[k] - 1
            new = (-float(score[k] / size[k]), int(begins[a]), int(ends[b]))
            best[int(rows[k])] = min(best.get(int(rows[k]), new), new)
    return [(int(of_text[p]), p, -s, b, e) for p, (s, b, e) in sorted(best.items())]


def hits(rows: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """``doc_id``, ``row0``, ``row1``, ``item``, ``score``, ``begin`` and ``end`` for rows with ``doc_id``,
    ``text``, ``row0`` and ``row1``."""
    key = ["row0", "row1"]
    rare = seeds(rows, known)
    held = stored(holders(rows, Sieve(rare)), "holders")
    met = passages(held, rare)
    # Items of a row go in groups of a bounded number, each beside a copy of the text.
    groups = met.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / PAIRS).alias("groups"))
    dealt = met.join(groups, key).withColumn("group", F.pmod(F.xxhash64("item"), "groups"))
    dealt = dealt.join(known.select("item", "words", "need"), "item")
    dealt = dealt.groupBy(*key, "group").agg(F.collect_list(F.struct("item", "words", "need", "starts")).alias("picked"))
    able = held.join(dealt, key)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = best_alignments(batch.column("text"), batch.column("picked"), least)
            if found:
                text, pick, score, begin, end = zip(*found)
                left = [batch.column(name).take(pa.array(text)) for name in ("doc_id", *key)]
                item = batch.column("picked").flatten().field("item").take(pa.array(pick))
                right = [pa.array(score), pa.array(begin, pa.int64()), pa.array(end, pa.int64())]
                yield pa.RecordBatch.from_arrays([*left, item, *right], ["doc_id", *key, "item", "score", "begin", "end"])

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, row0 long, row1 long, item string, score double, begin long, end long"
    return able.select("doc_id", *key, "text", "picked").mapInArrow(matched, schema)


def keyed(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), "text", *row_keys(F.col(doc_id), F.col("text")))


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", least: float = SCORE) -> DataFrame:
    """One row per contaminated document and item: ``doc_id``, ``item_id``, ``score``, and the passage as
    ``begin`` and ``end`` in the text's UTF-8 bytes."""
    known = known_items(items, item_id, least)
    found = hits(keyed(docs, doc_id), known, least).join(known.select("item", "item_id"), "item")
    return found.select("doc_id", "item_id", "score", "begin", "end")


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", least: float = SCORE) -> DataFrame:
    """The documents without the contaminated ones."""
    found = hits(keyed(docs, doc_id), known_items(items, item_id, least), least)
    bad = stored(found.select("row0", "row1").distinct(), "contaminated")
    row = F.struct(*[F.col(name) for name in docs.columns]).alias("row")
    rows = docs.select(row, *row_keys(F.col(doc_id), F.col("text")))
    return rows.join(bad, ["row0", "row1"], "left_anti").select("row.*")
