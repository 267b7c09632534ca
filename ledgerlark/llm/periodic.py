"""Periodic runs of words in a text, and the text with every run cut to its first period.

A run is a stretch of consecutive words with smallest period ``q`` that no neighbour extends, at least
``REPEATS`` periods and ``LEAST`` words long. Each run holds, at some place, the longest Lyndon word that
starts there, in the order of words or in the inverse order, and that word is as long as the period. So
every place gives two candidates: the next place whose suffix is smaller, or greater, ends the word. A
candidate is extended to both sides by the longest common extension of two places, in the text and in its
reversal. Both are answered by suffix trees, built by Ukkonen's method: the extension is the depth of the
lowest common ancestor of two leaves, which is the least depth between them on the tree's Euler tour, and a
table of minima over powers of two gives that at once. Leaves stand on the tour in the order of their
suffixes, so the tour also gives the order that Lyndon words need.

Most words of most texts lie in no run, and it takes no tree to see it: a run's every three words stand
again at a distance of its period, so at most a quarter of the length of any stretch around the run.
``stretches`` drops what fails that and keeps what is left, so no run is lost. Trees are built on stretches,
of several texts at once, with a symbol of its own after each; no run can hold such a symbol. Words are
compared themselves, not by hashes.

A row is worked on alone, in one pass without a shuffle. Memory follows the longest stretch that may be
periodic, at roughly 700 bytes a word.

Defined results: a null or empty text has no words, no runs and the empty text. Repeated rows get equal
results, an empty table gives an empty table. Columns are kept; ones named ``runs`` or ``collapsed`` are
replaced.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.expressions import WORD, let
from ledgerlark.llm.textbytes import flat, pieces

REPEATS, LEAST = 4, 6
#: Words of stretches that share a tree; a longer stretch has one for itself.
TOGETHER = 1 << 14
GRAM = 3

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of disjoint stretches of words that together hold every run."""
    n = len(ids)
    if n < LEAST:
        return []
    with np.errstate(over="ignore"):
        grams = ids[:-2].astype(np.uint64)
        for k in range(1, GRAM):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[k : n - GRAM + 1 + k].astype(np.uint64)
            grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    sorted_grams = grams[order]
    same = np.flatnonzero(sorted_grams[1:] == sorted_grams[:-1])
    if len(same) < LEAST // 2:
        return []
    before, after = order[same], order[same + 1]
    near = np.full(len(grams), n, np.int64)
    near[before] = after - before
    near[after] = np.minimum(near[after], after - before)
    left, found = [(0, n)], []
    while left:
        a, b = left.pop()
        marked = np.zeros(b - a, bool)
        marked[: b - a - GRAM + 1] = near[a : b - GRAM + 1] <= (b - a) // REPEATS
        edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0]))))
        inner = [(a + x, a + y + GRAM - 1) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()) if y - x + GRAM - 1 >= LEAST]
        if inner == [(a, b)]:
            found += inner
        else:
            left += inner
    return sorted(found)


class SuffixTree:
    """The suffix tree of a sequence of numbers whose last one stands nowhere else, by Ukkonen's method."""

    def __init__(self, text: list[int]):
        # Of every node: where its edge's label begins, how long that is, its suffix link, its children.
        n, begin, size, link, kids = len(text), [0], [0], [0], [{}]
        suffix = [-1]
        node = open_symbols = leaves = 0
        for i, symbol in enumerate(text):
            open_symbols += 1
            waiting = 0
            while open_symbols:
                first = text[i - open_symbols + 1]
                kid = kids[node].get(first)
                while kid is not None and open_symbols > size[kid]:
                    node = kid
                    open_symbols -= size[kid]
                    first = text[i - open_symbols + 1]
                    kid = kids[node].get(first)
                if kid is None:
                    kids[node][first] = len(begin)
                    link[waiting] = node
                    waiting = 0
                else:
                    at = begin[kid] + open_symbols - 1
                    if text[at] == symbol:
                        link[waiting] = node
                        break
                    inner = len(begin)
                    begin.append(begin[kid])
                    size.append(open_symbols - 1)
                    link.append(0)
                    suffix.append(-1)
                    kids.append({symbol: inner + 1, text[at]: kid})
                    begin[kid] = at
                    size[kid] -= open_symbols - 1
                    kids[node][first] = inner
                    link[waiting] = waiting = inner
                # A leaf's edge goes to the end of the text, whatever is still to come.
                begin.append(i)
                size.append(n)
                link.append(0)
                kids.append(None)
                suffix.append(leaves)
                leaves += 1
                if node:
                    node = link[node]
                else:
                    open_symbols -= 1
        self.size, self.kids, self.suffix, self.n = size, kids, suffix, n

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths along the Euler tour, and where on it the leaf of each suffix stands."""
        size, kids, suffix, n = self.size, self.kids, self.suffix, self.n
        place, depths = [0] * n, [0]
        way = [(iter(sorted(kids[0].items())), 0)]
        while way:
            rest, depth = way[-1]
            for _, kid in rest:
                if kids[kid] is None:
                    place[suffix[kid]] = len(depths)
                    depths += (n - suffix[kid], depth)
                else:
                    deeper = depth + size[kid]
                    depths.append(deeper)
                    way.append((iter(sorted(kids[kid].items())), deeper))
                    break
            else:
                way.pop()
                if way:
                    depths.append(way[-1][1])
        return np.array(depths, np.int32), np.array(place, np.int64)


class Extensions:
    """Longest common extensions of pairs of places of a sequence, each in constant time."""

    def __init__(self, text: list[int]):
        depths, self.place = SuffixTree(text).tour()
        rows = [depths]
        while 2 << (len(rows) - 1) <= len(depths):
            half = 1 << (len(rows) - 1)
            row = rows[-1].copy()
            row[:-half] = np.minimum(row[:-half], rows[-1][half:])
            rows.append(row)
        self.least = np.stack(rows)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        k = np.frexp(b - a)[1] - 1
        return np.minimum(self.least[k, a], self.least[k, b - (1 << k)])


def _next_below(rank: list[int]) -> list[int]:
    """For every place the next one with a lower rank, or the length."""
    found, open_places = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while open_places and rank[open_places[-1]] > r:
            found[open_places.pop()] = i
        open_places.append(i)
    return found


def runs_of(text: list[int]) -> np.ndarray:
    """Start, length and period of all runs, by start and period. The last number stands nowhere else."""
    n = len(text)
    ahead, behind = Extensions(text), Extensions(text[-2::-1] + text[-1:])
    start, period = [], []
    for rank in (ahead.place, -ahead.place):
        start.append(np.arange(n))
        period.append(np.array(_next_below(rank.tolist()), np.int64) - start[-1])
    i, q = np.concatenate(start), np.concatenate(period)
    kept = (i + q < n) & (q * REPEATS <= n)
    i, q = i[kept], q[kept]
    if not len(i):
        return np.zeros((0, 3), np.int64)
    right = ahead.of(i, i + q)
    # The reversal holds place x at n - 2 - x; its last place stands for what lies before the first.
    left = behind.of(n - 1 - i, n - 1 - i - q)
    found = np.stack([i - left, left + q + right, q], 1)
    found = found[found[:, 1] >= np.maximum(LEAST, REPEATS * q)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _runs_together(parts: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each part, from one pair of trees."""
    top = max(int(p.max()) for p in parts) + 1
    begins, text = [], []
    for k, p in enumerate(parts):
        begins.append(len(text))
        text += p.tolist()
        text.append(top + k)
    found = runs_of(text)
    owner = np.searchsorted(begins, found[:, 0], "right") - 1
    found[:, 0] -= np.array(begins, np.int64)[owner]
    return [found[owner == k] for k in range(len(parts))]


def runs_of_texts(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Start, length and period of the runs of texts given as numbered words."""
    none = np.zeros((0, 3), np.int64)
    found, waiting, words = [[none] for _ in texts], [], 0

    def flush() -> None:
        for (k, a, _), runs in zip(waiting, _runs_together([part for _, _, part in waiting])):
            found[k].append(runs + np.array([a, 0, 0]))
        waiting.clear()

    for k, ids in enumerate(texts):
        for a, b in stretches(ids):
            if waiting and words + b - a > TOGETHER:
                flush()
                words = 0
            waiting.append((k, a, ids[a:b]))
            words += b - a
    if waiting:
        flush()
    out = [np.concatenate(f) for f in found]
    return [r[np.lexsort((r[:, 2], r[:, 0]))] for r in out]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The documents, or their columns ``keep``, with ``runs``, by start and period, and ``collapsed``, the
    words that stand in no run after its first period, joined by a space. Starts count words from 0."""
    keep = docs.columns if keep is None else keep
    own = {"runs": T.ArrayType(RUN), "collapsed": T.StringType()}
    keep = [c for c in keep if c not in own]
    fields = [docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in own.items()]
    names = [*keep, *own]
    # The text goes first, under a name of its own, and is not sent back unless it is kept.
    docs = docs.select(F.col(text).alias("_text_read"), *keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text_read"):
            data, offsets = flat(batch.column(0))
            raw, at = data.tobytes(), offsets.tolist()
            # Splitting bytes at white space cuts at the six ASCII kinds of it, as words are defined.
            words = [raw[a:b].split() for a, b in zip(at, at[1:])]
            numbered = []
            for own_words in words:
                number = {w: k for k, w in enumerate(dict.fromkeys(own_words))}
                numbered.append(np.fromiter(map(number.__getitem__, own_words), np.int64, len(own_words)))
            runs = runs_of_texts(numbered)
            flat_runs = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            ends = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(flat_runs[:, c]) for c in range(3)], RUN.names)
            shorter = pa.array([_collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.ListArray.from_arrays(pa.array(ends), items), shorter], names)

    return docs.mapInArrow(judge, T.StructType(fields))


def replayed(text: Column, doc_id: Column) -> Column:
    """The text, for a tenth of the ids with the words from some place on repeating: test data that the text
    itself decides, with a period for 3 to 10 rounds or so."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def play(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % period)
        again = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n > 0, F.array_join(again, " ")).otherwise(text)

    played = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), play)
    return F.when((h % 10 == 0) & text.isNotNull(), played).otherwise(text)
