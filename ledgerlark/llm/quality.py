"""Document quality by a linear-chain conditional random field over lines.

A document is a sequence of lines, each good or bad. A line's features are its shares of capitals,
symbols, exclamation marks, digits, punctuation and repeated words, its length and the like, and the same
of the line before and the line after it. Neighbouring labels are tied by a learned transition matrix.
Forward and backward passes give each line's chance of being good; their mean, weighted by the lines'
lengths in bytes plus one, is the document's score.

Only documents are labelled, so the fit takes a document's label for all its lines. It uses at most
``EXAMPLES`` labelled documents of each label, those with the smallest hash of the id; the driver receives
the features of their lines, of which sequences of ``CHUNK`` lines are learned. The scores cover every
whole text.

Defined results: a null or empty text is one empty line and is scored as such. Without examples of both
labels every score is 0.5. Rows are judged one by one, so repeated rows get equal results; a repeated
label counts by its lowest value. An empty table gives an empty table. Other columns are kept, input
columns named ``score`` or ``predicted`` are replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.textbytes import WHITE, flat, owner, pieces, words

EXAMPLES = 1500
CHUNK = 64
STEPS, RATE, PENALTY = 400, 0.1, 1e-4

#: Bytes by kind; each becomes a share of the line's bytes that are not white space.
KINDS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "#$%&*", "|<>{}[]()/\\=+~^_@`\"'-")
OWN = len(KINDS) + 7
WIDTH = 3 * OWN + 1


def lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the index of each line's text and its length in bytes."""
    data, offsets = flat(texts)
    breaks = np.flatnonzero(data == 10)
    # Every text has one line more than line breaks.
    begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    text = np.sort(np.concatenate([np.arange(len(texts)), owner(breaks, offsets)]), kind="stable")
    last = np.concatenate([text[1:] != text[:-1], [True]])
    ends = np.where(last, offsets[text + 1], np.concatenate([begins[1:], [0]]) - 1)

    def total(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[ends] - sums[begins]

    seen = np.maximum(total(~WHITE[data]), 1)
    shares = []
    for kind in KINDS:
        marks = np.zeros(256, bool)
        marks[list(kind.encode())] = True
        shares.append(total(marks[data]) / seen)
    at, to, hashes = words(data, offsets, WHITE)
    line = np.searchsorted(begins, at, "right") - 1
    n = len(begins)
    count = np.bincount(line, minlength=n)
    again = np.zeros(len(at), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * (2 * np.arange(len(at), dtype=np.uint64) + np.uint64(1)))))
        rank = np.concatenate(([0], np.cumsum(count)))
        plain = np.concatenate(([np.uint64(0)], np.cumsum(hashes)))
        mark = plain[rank[1:]] - plain[rank[:-1]]
    same = np.zeros(n, bool)
    same[1:] = (mark[1:] == mark[:-1]) & (count[1:] == count[:-1]) & (count[1:] > 0) & (text[1:] == text[:-1])
    size = ends - begins
    stop = np.zeros(n, bool)
    stop[size > 0] = np.isin(data[ends[size > 0] - 1], list(b".!?:"))
    mean = np.bincount(line, to - at, minlength=n) / np.maximum(count, 1)
    own = np.stack(
        [*shares, np.bincount(line, again, minlength=n) / np.maximum(count, 1), same, stop, count == 0,
         np.log1p(size) / 8, np.log1p(count) / 8, mean / 16], 1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    tied = (text[1:] == text[:-1])[:, None]
    before[1:], after[:-1] = own[:-1] * tied, own[1:] * tied
    return np.concatenate([own, before, after, np.ones((n, 1))], 1), text, size


@dataclass
class Field:
    """A fitted model: weights of a line's features for good over bad; ties[a, b] scores b after a."""

    weights: np.ndarray
    ties: np.ndarray


def _padded(values: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Values by text and place in it, and how many each text has."""
    sizes = np.bincount(text, minlength=n)
    place = np.arange(len(text)) - np.concatenate(([0], np.cumsum(sizes)))[text]
    out = np.zeros((n, int(sizes.max(initial=0))))
    out[text, place] = values
    return out, sizes


def _passes(u: np.ndarray, sizes: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good over bad from the lines up to and with each one, and from the lines after it."""
    lse = np.logaddexp
    ahead, behind = np.zeros_like(u), np.zeros_like(u)
    ahead[:, :1] = u[:, :1]
    for t in range(1, u.shape[1]):
        a = ahead[:, t - 1]
        ahead[:, t] = u[:, t] + lse(a + ties[1, 1], ties[0, 1]) - lse(a + ties[1, 0], ties[0, 0])
    for t in range(u.shape[1] - 2, -1, -1):
        b = u[:, t + 1] + behind[:, t + 1]
        found = lse(b + ties[1, 1], ties[1, 0]) - lse(b + ties[0, 1], ties[0, 0])
        behind[:, t] = np.where(t + 1 < sizes, found, 0)
    return ahead, behind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def marginals(features: np.ndarray, text: np.ndarray, n: int, model: Field) -> np.ndarray:
    """The chance of every line to be good. Texts are ordered by length, so that padding stays small."""
    u, sizes = features @ model.weights, np.bincount(text, minlength=n)
    out, order = np.zeros(len(u)), np.argsort(sizes, kind="stable")
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for cut in range(0, n, 64):
        group = order[cut : cut + 64]
        rows = np.concatenate([np.arange(starts[g], starts[g + 1]) for g in group])
        inner = np.repeat(np.arange(len(group)), sizes[group])
        table, lengths = _padded(u[rows], inner, len(group))
        ahead, behind = _passes(table, lengths, model.ties)
        place = np.arange(len(rows)) - np.concatenate(([0], np.cumsum(lengths)))[inner]
        out[rows] = _sigmoid((ahead + behind)[inner, place])
    return out


def train(features: np.ndarray, text: np.ndarray, good: np.ndarray) -> Field:
    """Maximum likelihood with a quadratic penalty, by full gradients with adapted steps; ``good`` is 1
    or 0 for each text. Longer texts are learned as several sequences."""
    begins = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(good)))))
    part = (np.arange(len(text)) - begins[text]) // CHUNK
    _, first, chain = np.unique(text << 32 | part, return_index=True, return_inverse=True)
    label, n = good[text[first]].astype(float), len(first)
    table, sizes = _padded(np.ones(len(text)), chain, n)
    place = np.arange(len(chain)) - np.concatenate(([0], np.cumsum(sizes)))[chain]
    real = table[:, 1:] > 0
    wanted = np.zeros((2, 2))
    for y in (0, 1):
        wanted[y, y] = (sizes[label == y] - 1).sum()
    p = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        ties = p[WIDTH:].reshape(2, 2)
        u, _ = _padded(features @ p[:WIDTH], chain, n)
        ahead, behind = _passes(u, sizes, ties)
        miss = label[chain] - _sigmoid((ahead + behind)[chain, place])
        pairs = np.stack([a * ahead[:, :-1] + ties[a, b] + b * (u + behind)[:, 1:] for a in (0, 1) for b in (0, 1)])
        pairs = np.exp(pairs - pairs.max(0, keepdims=True))
        found = (pairs / pairs.sum(0) * real).sum((1, 2)).reshape(2, 2)
        gradient = np.concatenate([features.T @ miss, (wanted - found).ravel()]) / len(text) - PENALTY * p
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(p[:WIDTH], p[WIDTH:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", most: int = EXAMPLES) -> Field | None:
    """The model of a 0/1 label, or None without examples of both values."""
    key = F.xxhash64(F.col(doc_id))
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    parts = [
        known.filter(F.col(label) == v).orderBy(key, doc_id).limit(most).select(F.col(doc_id).alias("_id"), F.col(label).alias("_label"))
        for v in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1]).groupBy("_id").agg(F.min("_label").alias("_label"))
    # At most 2 * most rows, so they go to the texts and not the other way round.
    texts = docs.select(F.col(doc_id).alias("_doc"), "text")
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select(F.col("_label").cast("int").alias("label"), "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x, text, _ = lines(batch.column("text"))
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            packed = [x[a:b].astype(np.float32).tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(packed, pa.binary())], ["label", "x"])

    found = sorted((r.label, r.x) for r in rows.mapInArrow(featured, "label int, x binary").collect())
    good = np.array([r[0] for r in found], int)
    if len(set(good)) < 2:
        return None
    each = [np.frombuffer(r[1], np.float32).reshape(-1, WIDTH) for r in found]
    text = np.repeat(np.arange(len(each)), [len(x) for x in each])
    return train(np.concatenate(each).astype(float), text, good)


def score(docs: DataFrame, model: Field | None) -> DataFrame:
    """The documents with ``score`` (0 to 1, the weighted mean chance of a good line) and ``predicted``."""
    own = {"score": T.DoubleType(), "predicted": T.IntegerType()}
    docs = docs.drop(*[c for c in own if c in docs.columns])
    if model is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    schema = T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t in own.items()])
    names, at = [*docs.columns, *own], docs.columns.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x, text, size = lines(batch.column(at))
            chance = marginals(x, text, batch.num_rows, model)
            weight = size + 1
            mean = np.bincount(text, chance * weight) / np.bincount(text, weight)
            mean = np.clip(mean, 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mean), pa.array((mean >= 0.5).astype(np.int32))], names)

    return docs.mapInArrow(judge, schema)
