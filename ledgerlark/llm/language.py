"""Language identification by nearest centroid.

A text is lower-cased, everything but letters becomes a single space, and its bigrams and trigrams are
counted in ``DIMENSIONS`` hash cells, so many that few n-grams share one; only cells in use are held.
Counts become ``log(1 + count) * idf``, scaled to length 1. Every language has several centroids, found by
spherical k-means over its examples. A text gets the language of the centroid with the highest cosine; of
equal ones the first by language, then by cluster.

It is rejected if it has no letter, shares no cell with the centroid, or has a cosine of at most the
language's bound for its size, which is the number of its different cells in powers of two. Bounds come
from the examples and their beginnings of 4, 8, 16 and so on letters: half way between the cosine that all
but 1 % of the language's own reach and the one that all but 1 % of the others' reach for which the
language is the nearest wrong one, but at most ``BOUND`` of the first. Sizes beyond all examples have the
bound of the largest, sizes below all have 0.

The fit uses at most ``EXAMPLES`` texts per language, those with the smallest hash of id and text, each once. Their inverse
document frequencies, clusters and bounds are computed in tasks; one task holds the examples of one language. The
prediction covers every whole text.

Defined results: a null text and one without a letter give ``und`` with score 0, rejected. Without any
example everything is ``und``. Rows are judged one by one, so repeated rows get equal results; an empty
table gives an empty table. Other columns are kept, input columns named ``lang_pred``, ``score`` or
``rejected`` are replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.textbytes import pieces
from ledgerlark.session import stored

DIMENSIONS = 1 << 18
#: At most; a value up to 1000 lets Spark cut each language's rows before they are shuffled.
EXAMPLES = 600
CLUSTERS = 4
ROUNDS = 10
#: The largest bound, as a share of the cosine that 99 % of the examples reach.
BOUND = 0.9
#: Products of a text's and a centroid's cell that are formed at once.
PRODUCTS = 1 << 20
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, with a space around and between runs of them."""
    # A code point that UTF-32 refuses cannot occur in a Spark string.
    c = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32)
    c = np.where(_is_letter()[c], c, np.uint32(32))
    return c[(c != 32) | np.concatenate(([True], c[:-1] != 32))]


def counts(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram counts of results of ``letters``: text, cell and count of every cell in use, in this order."""
    c = np.concatenate(codes).astype(np.uint64)
    text = np.repeat(np.arange(len(codes)), [len(x) for x in codes])
    keys = []
    with np.errstate(over="ignore"):
        for n in (2, 3):
            if len(c) < n:
                continue
            h = np.zeros(len(c) - n + 1, np.uint64)
            for i in range(n):
                h = (h + c[i : len(c) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            cell = (h >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)
            whole = text[: len(h)] == text[n - 1 :]
            keys.append((text[: len(h)] * DIMENSIONS + cell)[whole])
    key, found = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_counts=True)
    return key // DIMENSIONS, key % DIMENSIONS, found


def _weighed(text: np.ndarray, cell: np.ndarray, found: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Values of the cells in use, of length 1 for each of the n texts."""
    x = np.log1p(found) * idf[cell]
    return x / np.maximum(np.sqrt(np.bincount(text, x * x, n)), 1e-12)[text]


def _sizes(text: np.ndarray, n: int) -> np.ndarray:
    """The size class of each text: the power of two of its number of cells in use."""
    return np.log2(np.maximum(np.bincount(text, minlength=n), 1)).astype(int)


def _cluster(text: np.ndarray, cell: np.ndarray, x: np.ndarray, n: int, k: int) -> np.ndarray:
    """Unit centroids; the first start is nearest to the mean, each next one farthest from all before."""

    def one(i: int) -> np.ndarray:
        return np.bincount(cell[text == i], x[text == i], DIMENSIONS)

    def near_to(centroid: np.ndarray) -> np.ndarray:
        return np.bincount(text, x * centroid[cell], n)

    centroids = [one(int(np.argmax(near_to(np.bincount(cell, x, DIMENSIONS)))))]
    near = near_to(centroids[0])
    while len(centroids) < min(k, n) and near.min() < 1 - 1e-6:
        centroids.append(one(int(np.argmin(near))))
        near = np.maximum(near, near_to(centroids[-1]))
    for _ in range(ROUNDS):
        to = np.argmax(np.stack([near_to(c) for c in centroids]), 0)
        for i in np.unique(to):
            mine = to[text] == i
            total = np.bincount(cell[mine], x[mine], DIMENSIONS)
            centroids[i] = total / max(np.linalg.norm(total), 1e-12)
    return np.stack(centroids).astype(np.float32)


@dataclass
class Languages:
    """A fitted model: one language per centroid, with the centroids' cells in use in order of cell.

    Entries ``first[c]`` to ``first[c + 1]`` are those of cell c. ``bounds`` has a row per centroid and a
    column per size class.
    """

    names: list[str]
    first: np.ndarray
    centroid: np.ndarray
    weight: np.ndarray
    bounds: np.ndarray
    idf: np.ndarray

    def near(self, text: np.ndarray, cell: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        """Cosines of n texts with all centroids."""
        x = _weighed(text, cell, found, self.idf, n)
        many = self.first[cell + 1] - self.first[cell]
        ends, out, at = np.cumsum(many), np.zeros(n * len(self.names)), 0
        while at < len(cell):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + PRODUCTS, "right")))
            m = many[at:to]
            entry = np.repeat(self.first[cell[at:to]] - (ends[at:to] - m - done), m) + np.arange(m.sum())
            key = np.repeat(text[at:to] * len(self.names), m) + self.centroid[entry]
            out += np.bincount(key, np.repeat(x[at:to], m) * self.weight[entry], len(out))
            at = to
        return out.reshape(n, len(self.names))


def _unpacked(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, cell and count from the columns ``cells`` and ``counts``."""
    cells, found = ([np.frombuffer(v, np.int32) for v in batch.column(c).to_pylist()] for c in ("cells", "counts"))
    text = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    return text, np.concatenate(cells), np.concatenate(found)


def fit(examples: DataFrame, doc_id: str = "doc_id", lang: str = "lang", per_language: int = EXAMPLES) -> Languages:
    """From the examples' texts and languages; rows with a null text or language are left out."""
    known = examples.filter(F.col("text").isNotNull() & F.col(lang).isNotNull())
    known = known.select(F.xxhash64(doc_id, "text").alias("key"), F.col(lang).alias("lang"), "text")
    order = Window.partitionBy("lang").orderBy("key")
    ranked = known.select("key", "lang").distinct().withColumn("n", F.row_number().over(order))
    # One row per language: the largest key that is still taken. Texts move only once they are chosen.
    tops = ranked.filter(F.col("n") <= per_language).groupBy("lang").agg(F.max("key").alias("top"))
    chosen = known.join(F.broadcast(tops), "lang").filter(F.col("key") <= F.col("top")).dropDuplicates(["lang", "key"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows=64):
            langs, whole, parts = [], [], []
            for said, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                c = letters(text)
                if len(c) < 2:
                    continue
                begun = [c[: 1 << j] for j in range(2, 64) if 1 << j < len(c)] if len(c) > 4 else []
                parts += [*begun, c]
                whole += [False] * len(begun) + [True]
                langs += [said] * (len(begun) + 1)
            if not parts:
                continue
            text, cell, found = counts(parts)
            cut = np.searchsorted(text, np.arange(1, len(parts)))
            packed = [pa.array([v.tobytes() for v in np.split(a.astype(np.int32), cut)], pa.binary()) for a in (cell, found)]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(whole), *packed], ["lang", "whole", "cells", "counts"])

    parts = stored(chosen.select("lang", "text").mapInArrow(vectors, "lang string, whole boolean, cells binary, counts binary"), "lang-vectors")
    rows = parts.filter("whole").select("lang", "cells", "counts")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for v in batch.column("cells").to_pylist():
                seen[np.frombuffer(v, np.int32)] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([seen.tobytes()], pa.binary())], ["n", "seen"])

    # One row per task, of at most per_language rows for each language.
    counted = rows.coalesce(8).mapInArrow(presence, "n long, seen binary").collect()
    n, seen = sum(p.n for p in counted), sum(np.frombuffer(p.seen, np.int64) for p in counted)
    idf = np.log((1 + n) / (1 + seen)) + 1 if n else np.ones(DIMENSIONS)

    def clustered(table: pa.Table) -> pa.Table:
        text, cell, found = _unpacked(table)
        n = table.num_rows
        centroids = _cluster(text, cell, _weighed(text, cell, found, idf, n), n, CLUSTERS)
        used = [np.flatnonzero(c) for c in centroids]
        return pa.table(
            {
                "lang": [table.column("lang")[0].as_py()] * len(centroids),
                "cells": [u.astype(np.int32).tobytes() for u in used],
                "weights": [c[u].tobytes() for c, u in zip(centroids, used)],
            },
            schema=pa.schema([("lang", pa.string()), ("cells", pa.binary()), ("weights", pa.binary())]),
        )

    found = rows.groupBy("lang").applyInArrow(clustered, "lang string, cells binary, weights binary").collect()
    found = sorted(found, key=lambda r: (r.lang, r.cells, r.weights))
    names = [r.lang for r in found]
    cells = [np.frombuffer(r.cells, np.int32) for r in found]
    cell = np.concatenate([*cells, np.zeros(0, np.int32)])
    weight = np.concatenate([*(np.frombuffer(r.weights, np.float32) for r in found), np.zeros(0, np.float32)])
    order = np.argsort(cell, kind="stable")
    first = np.searchsorted(cell[order], np.arange(DIMENSIONS + 1))
    centroid = np.repeat(np.arange(len(cells)), [len(c) for c in cells])[order]
    model = Languages(names, first, centroid, weight[order], np.zeros((len(names), 64)), idf)
    if not names:
        return model
    kind = np.array(sorted(set(names)))
    of = np.searchsorted(kind, names)

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = part.num_rows
                text, cell, found = _unpacked(part)
                near = model.near(text, cell, found, n)
                best = np.maximum.reduceat(near, np.searchsorted(of, np.arange(len(kind))), 1)
                own = np.searchsorted(kind, part.column("lang").to_pylist())
                reached = best[np.arange(n), own]
                best[np.arange(n), own] = -1
                other = best.argmax(1)
                columns = [np.concatenate(c).tolist() for c in ((own, other), (_sizes(text, n),) * 2, (reached, best.max(1)), (np.ones(n, bool), np.zeros(n, bool)))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "size", "cosine", "own"])

    said = parts.select("lang", "cells", "counts").mapInArrow(cosines, "kind long, size long, cosine double, own boolean")
    quantile = lambda own, q: F.percentile(F.when(F.col("own") == own, F.col("cosine")), F.lit(q))
    for r in said.groupBy("kind", "size").agg(quantile(True, 0.01).alias("own"), quantile(False, 0.99).alias("other")).orderBy("size").collect():
        if r.own is not None:
            bound = min((r.own + max(r.other or 0.0, 0.0)) / 2, BOUND * r.own)
            model.bounds[np.ix_(of == r.kind, np.arange(64) >= r.size)] = bound
    return model


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``."""
    docs = docs.drop(*[c for c in ("lang_pred", "score", "rejected") if c in docs.columns])
    new = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    schema = T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t in new])
    names = [*docs.columns, *(n for n, _ in new)]
    at = docs.columns.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows=128):
            codes = [letters(text) for text in batch.column(at).to_pylist()]
            lettered = np.array([len(c) > 1 for c in codes])
            n = batch.num_rows
            if model.names:
                text, cell, found = counts(codes)
                near = model.near(text, cell, found, n)
                best = near.argmax(1)
                score = np.clip(near[np.arange(n), best], 0, 1).astype(float)
                rejected = (score <= model.bounds[best, _sizes(text, n)]) | ~lettered
                said = [model.names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                score = np.where(lettered, score, 0.0)
            else:
                said, score, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string()), pa.array(score), pa.array(rejected)], names)

    return docs.mapInArrow(predict, schema)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string")) % n
