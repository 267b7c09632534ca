"""Toxicity by cumulative-link ordinal regression.

Grades 0 < 1 < ... < K - 1 share one weight per feature; thresholds t1 < ... < t(K-1) separate them:
P(grade >= k) = 1 / (1 + exp(t_k - w.x)). The severity is the expected grade, the sum of these chances.
Features are the words a text contains (runs of letters, A-Z lower-cased) and their beginnings of ``STEMS``
bytes, so that one stem is known in words that no example holds; each of them once as such, and once more for
each of ``TIMES`` and ``SHARES`` that it reaches: how often it stands in the text, and which part of the text's
words it is. They fall into 2^20 hash cells. Of them, those that go with the grade most clearly are kept, at
most ``FEATURES``.

``graded`` makes three grades of a 0/1 label: 0 stays 0; labelled texts are 2 if they hold more kinds of
typical features than the median of labelled texts and 1 otherwise. Typical features are those whose share among
labelled texts exceeds their share among the others by 0.1 or more.

A text is toxic if its chance of grade 1 or more reaches a cut. Likelihood alone leaves the cut too high where
toxic texts are few, so it is placed by texts that were not learned from: each of ``FOLDS`` parts of the examples
is judged by a model of the others, and of all cuts that leave at least ``CLEAN`` of the examples of grade 0
alone it is the one at which the shares of toxic ones found and of clean ones left alone add up to the most. It
is never above one half, and is one half where there are too few examples of one of the labels.

The fit uses at most ``EXAMPLES`` labelled texts of each label, those with the smallest hash of the id; the
driver receives at most that many lists of hash cells. The scores cover every whole text.

Defined results: null and empty texts hold no words, their severity follows from the thresholds alone.
Texts without a label are not learned from. Without examples of both labels the severity is 0 and no text
is toxic. Repeated rows get equal results, a repeated label counts by its highest value; an empty table
gives an empty table. Other columns are kept, input columns named like a result are replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.textbytes import NOT_LETTER, beginnings, flat, mixed, owner, pieces, words

CELL_BITS = 20
#: Bytes of a word's beginnings, times that a feature stands in a text, and words of the text for one of it.
STEMS, TIMES, SHARES = (4, 5, 6, 7, 8), (2, 3), (150, 75)
EXAMPLES = 3000
FEATURES = 2000
#: A feature must occur in so many examples, and its mean grade differ by so many standard errors.
LEAST, CLEAR = 3, 2.5
#: Parts of the examples that place the cut, and the least share of clean ones that it leaves alone.
FOLDS, CLEAN = 5, 0.95
STEPS, RATE, PENALTY = 300, 0.1, 1e-3


def cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, hash cell) pairs, ordered."""
    data, offsets = flat(texts)
    begins, ends, hashes = words(data, offsets, NOT_LETTER)
    text = owner(begins, offsets)
    many = np.bincount(text, minlength=len(texts))
    stems = [beginnings(data, begins, ends, size) for size in STEMS]
    row = np.concatenate([text, *(text[word] for word, _ in stems)])
    found = np.concatenate([hashes, *(h for _, h in stems)])
    pairs, times = np.unique((row << CELL_BITS) | (found >> np.uint64(64 - CELL_BITS)).astype(np.int64), return_counts=True)
    row, cell = pairs >> CELL_BITS, (pairs & ((1 << CELL_BITS) - 1)).astype(np.uint64)
    reached = [times >= n for n in TIMES] + [times * n >= many[row] for n in SHARES]
    more = [
        (row[k] << CELL_BITS) | (mixed((cell[k] << np.uint64(8)) + np.uint64(i)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)
        for i, k in enumerate(reached, 1)
    ]
    pairs = np.unique(np.concatenate([pairs, *more]))
    return pairs >> CELL_BITS, pairs & ((1 << CELL_BITS) - 1)


@dataclass
class Grades:
    """A fitted model: weights of the kept cells, and the thresholds in ascending order."""

    kept: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    #: Log odds of grade 1 or more from which on a text is toxic.
    cut: float = 0.0


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, label: str, most: int) -> DataFrame:
    key = F.xxhash64(F.col(doc_id))
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    parts = [
        known.filter(F.col(label) == v).orderBy(key, doc_id).limit(most).select(F.col(doc_id).alias("_id"), F.col(label).alias("_label"))
        for v in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1]).groupBy("_id").agg(F.max("_label").alias("_label"))
    texts = docs.select(F.col(doc_id).alias("_doc"), "text")
    # At most 2 * most rows, so they go to the texts and not the other way round.
    return texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select(F.col("_label").cast("int").alias("label"), "text")


def graded(seen: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1 and 2 of examples with the given cells."""
    n = 1 << CELL_BITS
    share = [sum((np.bincount(s, minlength=n) for s in (np.concatenate(part),)), 0) / len(part) for part in ([x for x, t in zip(seen, toxic) if t == v] for v in (0, 1))]
    typical = share[1] - share[0] >= 0.1
    held = np.array([typical[s].sum() for s in seen])
    return np.where(toxic == 0, 0, np.where(held > np.median(held[toxic == 1]), 2, 1))


def _select(seen: list[np.ndarray], grade: np.ndarray, most: int) -> np.ndarray:
    """Cells with the largest difference between their holders' mean grade and the overall mean, in
    standard errors."""
    n = 1 << CELL_BITS
    every = np.concatenate(seen)
    count = np.bincount(every, minlength=n)
    total = np.bincount(every, np.repeat(grade, [len(s) for s in seen]), minlength=n)
    spread = max(float(grade.std()), 1e-9)
    strength = np.abs(total - count * grade.mean()) / (spread * np.sqrt(np.maximum(count, 1)))
    strength[count < LEAST] = 0
    best = np.argsort(-strength, kind="stable")[:most]
    return np.sort(best[strength[best] > CLEAR])


def train(seen: list[np.ndarray], grade: np.ndarray, most: int = FEATURES) -> Grades:
    """Maximum likelihood with a quadratic penalty, by full gradients with adapted steps."""
    kept = _select(seen, grade, most)
    k = int(grade.max()) + 1
    rows = np.repeat(np.arange(len(seen), dtype=np.int32), [len(s) for s in seen])
    at = np.searchsorted(kept, cols := np.concatenate(seen))
    hit = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == cols) if len(kept) else np.zeros(len(cols), bool)
    rows, cols = rows[hit], at[hit]
    above = grade[:, None] >= np.arange(1, k)
    n, shares = len(seen), np.clip(above.mean(0), 1e-3, 1 - 1e-3)
    first = np.log((1 - shares[0]) / shares[0])
    # Thresholds are the first one and the logarithms of the steps between them, so they stay in order.
    p = np.concatenate([np.zeros(len(kept)), [first], np.zeros(k - 2)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, t = p[: len(kept)], p[len(kept)] + np.concatenate(([0], np.cumsum(np.exp(p[len(kept) + 1 :]))))
        s = np.bincount(rows, w[cols], minlength=n)
        chance = np.concatenate([np.ones((n, 1)), 1 / (1 + np.exp(np.clip(t - s[:, None], -30, 30))), np.zeros((n, 1))], 1)
        slope = chance * (1 - chance)
        i = np.arange(n)
        own = np.maximum(chance[i, grade] - chance[i, grade + 1], 1e-9)
        ds = (slope[i, grade] - slope[i, grade + 1]) / own
        dt = np.zeros((n, k + 1))
        dt[i, grade] -= slope[i, grade] / own
        dt[i, grade + 1] += slope[i, grade + 1] / own
        dt = dt[:, 1:k].mean(0)
        steps = np.exp(p[len(kept) + 1 :])
        gap = np.array([dt[j + 1 :].sum() for j in range(k - 2)]) * steps
        gradient = np.concatenate([np.bincount(cols, ds[rows], minlength=len(kept)) / n - PENALTY * w, [dt.sum()], gap])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Grades(kept, p[: len(kept)], p[len(kept)] + np.concatenate(([0], np.cumsum(np.exp(p[len(kept) + 1 :])))))


def _log_odds(model: Grades, seen: list[np.ndarray]) -> np.ndarray:
    weight = np.zeros(1 << CELL_BITS)
    weight[model.kept] = model.weights
    return np.array([weight[s].sum() for s in seen]) - model.thresholds[0]


def place_cut(seen: list[np.ndarray], toxic: np.ndarray, folds: int = FOLDS, clean: float = CLEAN) -> float:
    """The log odds that part toxic from clean examples best, each judged by a model that did not see it."""
    part = np.empty(len(seen), int)
    for y in (0, 1):
        own = np.flatnonzero(toxic == y)
        part[own] = np.arange(len(own)) % folds
        if len(own) < 2 * folds:
            return 0.0
    odds = np.empty(len(seen))
    for f in range(folds):
        rest = np.flatnonzero(part != f)
        learned = [seen[k] for k in rest]
        model = train(learned, graded(learned, toxic[rest]))
        held = np.flatnonzero(part == f)
        odds[held] = _log_odds(model, [seen[k] for k in held])
    below, above = np.sort(odds[toxic == 0]), np.sort(odds[toxic == 1])
    left = np.searchsorted(below, above, "left")
    found = 1 - np.arange(len(above)) / len(above)
    sums = np.where(left >= clean * len(below), left / len(below) + found, -1)
    best = int(np.argmax(sums))
    if sums[best] < 0:
        return min(0.0, float(np.quantile(below, clean)))
    # Half way to the next clean example below.
    return min(0.0, float((above[best] + (below[left[best] - 1] if left[best] else above[best])) / 2))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic", most: int = EXAMPLES) -> Grades | None:
    """The model of a 0/1 label, or None without examples of both values."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            row, cell = cells(batch.column("text"))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            packed = [cell[a:b].astype(np.int32).tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(packed, pa.binary())], ["label", "cells"])

    rows = _sample(docs, labels, doc_id, label, most).mapInArrow(listed, "label int, cells binary").collect()
    rows = sorted((r.label, r.cells) for r in rows)
    toxic, seen = np.array([r[0] for r in rows], int), [np.frombuffer(r[1], np.int32) for r in rows]
    if len(set(toxic)) < 2:
        return None
    model = train(seen, graded(seen, toxic))
    model.cut = place_cut(seen, toxic)
    return model


def rate(docs: DataFrame, model: Grades | None) -> DataFrame:
    """The documents with ``severity`` (expected grade), ``grade`` (most likely) and ``toxic`` (the
    chance of grade 1 or more reaches the cut)."""
    own = {"severity": T.DoubleType(), "grade": T.IntegerType(), "toxic": T.BooleanType()}
    docs = docs.drop(*[c for c in own if c in docs.columns])
    if model is None:
        return docs.withColumns({"severity": F.lit(0.0), "grade": F.lit(0), "toxic": F.lit(False)})
    schema = T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t in own.items()])
    names, at = [*docs.columns, *own], docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << CELL_BITS)
        weight[model.kept] = model.weights
        for batch in pieces(batches):
            row, cell = cells(batch.column(at))
            s = np.bincount(row, weight[cell], minlength=batch.num_rows)
            chance = 1 / (1 + np.exp(np.clip(model.thresholds - s[:, None], -30, 30)))
            whole = np.concatenate([np.ones((len(s), 1)), chance, np.zeros((len(s), 1))], 1)
            grade = np.argmax(whole[:, :-1] - whole[:, 1:], 1).astype(np.int32)
            found = [pa.array(chance.sum(1)), pa.array(grade), pa.array(s - model.thresholds[0] >= model.cut)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names)

    return docs.mapInArrow(score, schema)
