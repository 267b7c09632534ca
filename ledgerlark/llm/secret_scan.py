"""Secrets in texts: what fixed rules find, and what looks and stands like it.

The rules are patterns of assignments, access keys and hexadecimal keys. Their findings are labels: every
candidate, a longer run of token characters or a value behind ``=`` or ``:``, is a positive example where it
overlaps a finding and a negative one elsewhere. A convolutional network over characters learns them: each
character of the candidate and of ``BEFORE`` and ``AFTER`` characters around it is embedded, in one way inside
and in another outside of it; filters ``WIDE`` characters wide slide over all of them, and the greatest and the
mean responses before, inside and behind the candidate decide. Every example is learned in three forms: as it
is; without surroundings, so that a key in a strange place is known by its looks; and with other letters, so
that capitals alone make no key and no fixed alphabet is needed for one.

Every distinct value of the texts is an example, learned from in the place that sorts first. Examples are dealt
out to groups of about ``GROUP``; in each of ``TURNS`` turns every group goes on from the same network over all of
its examples, and the networks' mean goes into the next turn. A label of which there are few goes to several
groups, so that each has ``FEW`` of it if there are so many. Means are taken in whole numbers, so they depend on
no order.

Two more networks learn from one half of the examples each and judge the other half. That calibrates: a logistic
curve turns outputs into chances, and for assigned and for free-standing candidates apart the threshold is the
highest chance that still finds ``RECALL`` of the positive ones, by counts of all examples on a grid of 1 /
``GRID``. Above it a candidate is reported as kind ``model``, unless a rule has found it already. What the rules
find always stays. Where a half lacks one of the labels, the network is judged by what it learned from.

The driver receives the summed weights and the counts on the grid, whatever the input. The scan covers every
candidate of every whole text. A candidate of any length is read whole, by pieces.

Defined results: a null or empty text has no findings. Without positive or without negative examples only
rules apply. Repeated rows get equal results; a value that is found by a rule in one place and not in another
is a positive example. An empty table gives an empty table. Places count code points. Columns are kept; one
named ``spans`` is replaced.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.textbytes import pieces
from ledgerlark.session import stored

#: Examples of a group, about, and at least of each label; turns; least steps of a group in one turn.
GROUP, FEW, TURNS, STEPS = 32_000, 2000, 3, 500
RECALL = 0.98
BEFORE, AFTER = 16, 8
DEPTH, FILTERS, WIDE = 8, 24, 5
BATCH, RATE, PENALTY = 128, 0.01, 1e-4
#: Outputs are counted in steps of 1 / GRID up to FAR from 0; weights are summed in steps of 1 / FINE.
GRID, FAR, FINE = 256, 40, 1 << 32
#: Characters that are looked at together; a longer candidate is read in several pieces.
PIECE = 1 << 16

#: The kinds in the order in which findings with one start are listed. Fixed patterns.
ASSIGN, ACCESS, HEX, MODEL = KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGNED = re.compile(r"""[:=]["']?\x20*["']?([A-Za-z0-9+/_.=-]{6,})""")
_FREE = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{11,}[A-Za-z0-9+/_-]={0,2}")

_DRAWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
     T.StructField("score", T.DoubleType())]
)


def findings(text: str) -> list[tuple[int, int, int]]:
    """Start, kind's number and end of what the rules find."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    # Runs of at least 24 are the maximal runs that are long enough.
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Start, end and form of all candidates: form 0 is assigned, form 1 stands free."""
    found = []
    if "=" in text or ":" in text:
        found += [(*m.span(1), 0) for m in _ASSIGNED.finditer(text)]
    taken = {a for a, _, _ in found}
    ends = [b for _, b, _ in found]
    starts = [a for a, _, _ in found]
    for m in _FREE.finditer(text):
        a, b = m.span()
        k = int(np.searchsorted(ends, a, "right")) if ends else 0
        if a not in taken and not (k < len(ends) and starts[k] < b):
            found.append((a, b, 1))
    return sorted(found)


def _overlaps(spans: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each candidate shares a character with a finding. Both are sorted by start."""
    if not base:
        return [False] * len(spans)
    # The furthest end of all findings that start before some place.
    starts, reach = [a for a, _, _ in base], np.maximum.accumulate([b for _, _, b in base])
    before = np.searchsorted(starts, [b for _, b, _ in spans], "left")
    return [bool(k) and bool(reach[k - 1] > a) for k, (a, _, _) in zip(before.tolist(), spans)]


@dataclass
class Network:
    """Weights; ``places`` embeds a character by code and by whether it is inside the candidate."""

    places: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    thresholds: tuple[float, float] = (1.0, 1.0)


#: Rows of the embedding: 128 characters outside, 128 inside, and one that stays zero, between candidates.
ROWS, GAP = 257, 256
FEATURES = 6 * FILTERS + 2


def _laid_out(examples: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters as rows of the embedding, with gaps, the part each belongs to, and the sizes of parts."""
    sizes = np.array([[len(part) for part in e] for e in examples], np.int64).reshape(-1, 3)
    gap = b"\0" * (WIDE // 2)
    # A character beyond ASCII becomes one question mark.
    raw = gap + gap.join("".join(e).encode("ascii", "replace") + gap for e in examples)
    codes = np.frombuffer(raw, np.uint8).astype(np.int64)
    steps = np.zeros((len(examples), 4), np.int64)
    steps[:, :3], steps[:, 3] = sizes, 2 * len(gap)
    steps[-1:, 3] = len(gap)
    names = np.full((len(examples), 4), -1, np.int64)
    names[:, :3] = np.arange(3 * len(examples)).reshape(-1, 3)
    part = np.concatenate([np.full(len(gap), -1), np.repeat(names.ravel(), steps.ravel())])
    return np.where(part < 0, GAP, codes + 128 * (part % 3 == 1)), part, sizes.ravel()


def _responses(net: Network, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of embedded characters, and what the filters give for each; edges count as gaps."""
    x = net.places[np.pad(codes, WIDE // 2, constant_values=GAP)]
    windows = np.concatenate([x[k : k + len(codes)] for k in range(WIDE)], 1)
    return windows, np.maximum(windows @ net.filters + net.bias, 0)


def _pooled(response: np.ndarray, part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest and summed response of every part."""
    best, total = np.zeros((parts, FILTERS), response.dtype), np.zeros((parts, FILTERS), response.dtype)
    inside = np.flatnonzero(part >= 0)
    if len(inside):
        runs = np.flatnonzero(np.concatenate(([True], np.diff(part[inside]) != 0)))
        best[part[inside[runs]]] = np.maximum.reduceat(response[inside], runs)
        total[part[inside[runs]]] = np.add.reduceat(response[inside], runs)
    return best, total


def _features(best: np.ndarray, total: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    mean = total / np.maximum(sizes, 1)[:, None].astype(total.dtype)
    n = len(sizes) // 3
    own = np.concatenate([best.reshape(n, -1), mean.reshape(n, -1), np.log1p(sizes[1::3])[:, None] / 4, np.ones((n, 1))], 1)
    return own.astype(best.dtype, copy=False)


def outputs(net: Network, examples: list[tuple[str, str, str]]) -> np.ndarray:
    """The network's output for every candidate (before, inside, behind), over all of its characters."""
    if not examples:
        return np.zeros(0)
    codes, part, sizes = _laid_out(examples)
    best, total = np.zeros((len(sizes), FILTERS)), np.zeros((len(sizes), FILTERS))
    halo = WIDE // 2
    for a in range(0, len(codes), PIECE):
        b = min(a + PIECE, len(codes))
        low, high = max(a - halo, 0), min(b + halo, len(codes))
        _, response = _responses(net, codes[low:high])
        more, added = _pooled(response[a - low : b - low], part[a:b], len(sizes))
        best, total = np.maximum(best, more), total + added
    return _features(best, total, sizes) @ net.output


def gradients(net: Network, examples: list[tuple[str, str, str]], label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean logistic loss with penalty, and its gradients by embedding, filters, bias and output."""
    codes, part, sizes = _laid_out(examples)
    windows, response = _responses(net, codes)
    best, total = _pooled(response, part, len(sizes))
    features = _features(best, total, sizes)
    z = features @ net.output
    loss = np.mean(np.logaddexp(0, z) - label * z) + PENALTY / 2 * np.sum(net.output**2)
    miss = (1 / (1 + np.exp(-z)) - label) / len(label)
    to_output = features.T @ miss + PENALTY * net.output
    spread = miss[:, None] * net.output
    n = 3 * FILTERS
    to_best = spread[:, :n].reshape(-1, FILTERS)
    to_mean = spread[:, n : 2 * n].reshape(-1, FILTERS) / np.maximum(sizes, 1)[:, None].astype(spread.dtype)
    back = np.zeros_like(response)
    inside = part >= 0
    own = part[inside]
    top = response[inside] == best[own]
    ties = np.zeros_like(best)
    runs = np.flatnonzero(np.concatenate(([True], np.diff(own) != 0)))
    ties[own[runs]] = np.add.reduceat(top.astype(best.dtype), runs)
    back[inside] = to_best[own] * top / np.maximum(ties[own], 1) + to_mean[own]
    back *= response > 0
    to_windows = back @ net.filters.T
    to_places = np.zeros_like(net.places)
    wide = np.pad(codes, WIDE // 2, constant_values=GAP)
    for k in range(WIDE):
        cells = (wide[k : k + len(codes), None] * DEPTH + np.arange(DEPTH)).ravel()
        to_places += np.bincount(cells, to_windows[:, k * DEPTH : (k + 1) * DEPTH].ravel(), ROWS * DEPTH).reshape(ROWS, DEPTH)
    to_places[GAP] = 0
    return float(loss), [to_places, windows.T @ back, back.sum(0), to_output]


def fresh(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    places = rng.normal(0, 0.3, (ROWS, DEPTH))
    places[GAP] = 0
    return Network(places, rng.normal(0, (WIDE * DEPTH) ** -0.5, (WIDE * DEPTH, FILTERS)), np.zeros(FILTERS), np.zeros(FEATURES))


def improve(net: Network, examples: list[tuple[str, str, str]], label: np.ndarray, turn: int, turns: int = TURNS, seed: int = 7) -> Network:
    """What one turn over all examples makes of a network; in three turns every one takes all of its forms. Both labels
    weigh the same in every step; the one with fewer examples is gone through more often."""
    rng, n, half = np.random.default_rng([seed, turn]), len(examples), BATCH // 2
    forms, _ = varied(examples, label, [seed, turn])
    sides = [np.flatnonzero(label == y) for y in (0, 1)]
    sides = [s for s in sides if len(s)]
    steps = max(STEPS, -(-max(map(len, sides)) // half))
    order = []
    for s in sides:
        times = range(-(-steps * half // len(s)))
        order.append(np.concatenate([(drawn + turn + again) % 3 * n + drawn for again in times for drawn in [rng.permutation(s)]]))
    label, weights = label.astype(np.float32), [w.astype(np.float32) for w in _weights(net)]
    net = Network(*weights)
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        chosen = np.concatenate([o[(step - 1) * half : step * half] for o in order])
        _, found = gradients(net, [forms[k] for k in chosen], label[chosen % n])
        rate = RATE * (1 - (turn + step / (steps + 1)) / turns)
        for k, g in enumerate(found):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def varied(examples: list[tuple[str, str, str]], label: np.ndarray, seed: int | list[int] = 7) -> tuple[list, np.ndarray]:
    """The examples, all of them once more without surroundings, and what keeps its label when its letters
    change: a negative value in capitals, and a positive one drawn anew from letters and digits."""
    rng = np.random.default_rng(seed)
    changed = []
    for (before, value, after), y in zip(examples, label):
        drawn = "".join(_DRAWN[k] for k in rng.integers(0, len(_DRAWN), len(value))) if y else value.upper()
        changed.append((before, drawn, after))
    return examples + [("", e[1], "") for e in examples] + changed, np.tile(label, 3)


def chances(net: Network, z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(net.slope * z + net.offset, -40, 40)))


def calibrate(net: Network, z: np.ndarray, label: np.ndarray, form: np.ndarray, recall: float = RECALL, count: np.ndarray | None = None) -> None:
    """Fits the logistic curve by shortened Newton steps and places the thresholds; ``count`` is how many
    examples each row stands for."""
    count = np.ones(len(z), np.int64) if count is None else count
    many = [count[label == 0].sum(), count[label > 0].sum()]
    # Targets stop short of 0 and 1, as usual for this curve, so that it stays finite.
    target = np.where(label > 0, (many[1] + 1) / (many[1] + 2), 1 / (many[0] + 2))
    x, w = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        return float(np.sum(count * (np.logaddexp(0, x @ w) - target * (x @ w))))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        move = np.linalg.solve((x * (count * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (count * (p - target)))
        pace = 1.0
        while pace > 1e-6 and loss(w - pace * move) > loss(w):
            pace /= 2
        w = w - pace * move if pace > 1e-6 else w
    a, b = w
    net.slope, net.offset = max(float(a), 1e-3), float(b)
    p = chances(net, z)
    placed = []
    for f in (0, 1):
        own = (label > 0) & (form == f)
        own = np.flatnonzero(own if own.any() else label > 0)
        own = own[np.argsort(p[own])]
        missed = int(np.floor((1 - recall) * count[own].sum() + 1e-9))
        placed.append(float(p[own[np.searchsorted(np.cumsum(count[own]), missed, "right")]]) if len(own) else 1.0)
    net.thresholds = (placed[0], placed[1])


def _surrounded(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(0, a - BEFORE) : a], text[a:b], text[b : b + AFTER]


def _examples(docs: DataFrame, text: str) -> DataFrame:
    """Every distinct candidate of all texts, with its label, form, surroundings and half."""

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t"):
            own: dict[str, tuple] = {}
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                spans = candidates(t)
                for (a, b, form), found in zip(spans, _overlaps(spans, findings(t))):
                    label, *at = own.get(t[a:b], (False,))
                    row = (form, *_surrounded(t, a, b))
                    own[t[a:b]] = (label or found, min(at[0], row) if at else row)
            rows = [(value, int(label), form, before, after) for value, (label, (form, before, _, after)) in own.items()]
            names = ["value", "label", "form", "before", "after"]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    found = docs.select(F.col(text).alias("t")).mapInArrow(labelled, "value string, label int, form int, before string, after string")
    first = F.min(F.struct("form", "before", "after")).alias("at")
    once = found.groupBy("value").agg(F.max("label").alias("label"), first)
    half = F.pmod(F.xxhash64("value", F.lit("half")), F.lit(2)).cast("int")
    return once.select("value", "label", "at.*", half.alias("half"))


def _dealt(examples: DataFrame, counts: dict[tuple[int, int], int], nets: int) -> DataFrame:
    """One row per group of a network: network 0 learns from all examples, 1 and 2 from one half, judging 0 and 1."""
    parts, rows = [], 0
    for net in range(nets):
        many = {y: sum(n for (label, half), n in counts.items() if label == y and (not net or half == 2 - net)) for y in (0, 1)}
        groups = max(many.values()) // GROUP + 1
        rows += groups
        for y in (0, 1):
            copies = min(groups, -(-FEW * groups // max(many[y], 1)))
            own = examples.filter(F.col("label") == y) if not net else examples.filter((F.col("label") == y) & (F.col("half") == 2 - net))
            to = F.explode(F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda i: F.pmod(F.xxhash64("value") + i, F.lit(groups)).cast("int")))
            parts.append(own.select(F.lit(net).alias("net"), to.alias("group"), "label", "before", "value", "after"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("value").combine_chunks()
        ends = pa.array([0, table.num_rows], pa.int32())
        lists = {c: pa.ListArray.from_arrays(ends, table.column(c).combine_chunks()) for c in ("label", "before", "value", "after")}
        return pa.table({c: table.column(c)[:1] for c in ("net", "group")} | lists)

    schema = "net int, group int, label array<int>, before array<string>, value array<string>, after array<string>"
    tasks = min(rows, max(examples.sparkSession.sparkContext.defaultParallelism, int(examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return every.repartition(tasks, "net", "group").groupBy("net", "group").applyInArrow(packed, schema)


def _turned(groups: DataFrame, nets: list[Network], turn: int) -> list[Network]:
    """The mean of what all groups make of their network."""

    def improved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                examples = list(zip(row["before"], row["value"], row["after"]))
                net = improve(nets[row["net"]], examples, np.array(row["label"]), turn)
                flat = np.rint(np.concatenate([w.ravel() for w in _weights(net)]).astype(float) * FINE).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([row["net"]], pa.int32()), pa.array([flat], pa.list_(pa.int64()))], ["net", "weights"])

    rows = groups.mapInArrow(improved, "net int, weights array<long>").select("net", F.posexplode("weights"))
    rows = rows.groupBy("net", "pos").agg(F.sum("col").alias("total"), F.count(F.lit(1)).alias("many")).collect()
    means = [np.zeros(sum(w.size for w in _weights(net))) for net in nets]
    for r in rows:
        means[r.net][r.pos] = r.total / r.many / FINE
    cuts = np.cumsum([w.size for w in _weights(nets[0])])[:-1]
    return [Network(*(part.reshape(w.shape) for part, w in zip(np.split(mean, cuts), _weights(net)))) for mean, net in zip(means, nets)]


def _weights(net: Network) -> list[np.ndarray]:
    return [net.places, net.filters, net.bias, net.output]


def _judged(examples: DataFrame, nets: list[Network]) -> list[np.ndarray]:
    """Outputs on the grid, label, form and how many examples; each is judged by the network that did not learn it."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "value"):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("before", "value", "after"))))
            half = batch.column("half").to_numpy() + 1 if len(nets) > 1 else np.zeros(len(rows), int)
            z = np.zeros(len(rows))
            for k in np.unique(half):
                z[half == k] = outputs(nets[k], [rows[i] for i in np.flatnonzero(half == k)])
            cell = np.floor(np.clip(z, -FAR, FAR) * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("form"), pa.array(cell)], ["label", "form", "cell"])

    rows = examples.mapInArrow(judged, "label int, form int, cell int").groupBy("cell", "label", "form").count()
    rows = np.array(sorted(tuple(r) for r in rows.collect()), np.int64).reshape(-1, 4)
    return [rows[:, 0] / GRID, rows[:, 1].astype(float), rows[:, 2], rows[:, 3]]


def fit(docs: DataFrame, text: str = "text") -> Network | None:
    """The network trained and calibrated by all examples, or None without positive or negative ones."""
    examples = stored(_examples(docs, text), "secret-examples")
    counts = {(r.label, r.half): r["count"] for r in examples.groupBy("label", "half").count().collect()}
    if len({label for label, _ in counts}) < 2:
        return None
    nets = [fresh() for _ in range(3 if len(counts) == 4 else 1)]
    groups = stored(_dealt(examples, counts, len(nets)), "secret-groups")
    for turn in range(TURNS):
        nets = _turned(groups, nets, turn)
    z, label, form, count = _judged(examples, nets)
    calibrate(nets[0], z, label, form, count=count)
    return nets[0]


def find(docs: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The documents, or their columns ``keep``, with ``spans``: kind, start, end (exclusive) and the chance
    of what the network adds, by start and then kind."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    names = [*keep, "spans"]
    docs_read = docs.select(F.col(text).alias("_text_read"), *keep)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text_read"):
            spans, asked, forms, where = [], [], [], []
            for row, t in enumerate(batch.column(0).to_pylist()):
                t = t or ""
                base = findings(t)
                spans.append([(a, kind, b, None) for a, kind, b in base])
                if net is None:
                    continue
                own = candidates(t)
                for (a, b, form), found in zip(own, _overlaps(own, base)):
                    if not found:
                        asked.append(_surrounded(t, a, b))
                        forms.append(form)
                        where.append((row, a, b))
            for cut in range(0, len(asked), 2048) if net else ():
                p = chances(net, outputs(net, asked[cut : cut + 2048]))
                bound = np.array(net.thresholds)[forms[cut : cut + 2048]]
                for k in np.flatnonzero(p >= bound).tolist():
                    row, a, b = where[cut + k]
                    spans[row].append((a, 3, b, float(p[k])))
            flat = [s for own in spans for s in sorted(own, key=lambda s: s[:3])]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in spans]))).astype(np.int32)
            items = pa.StructArray.from_arrays(
                [pa.array([KINDS[s[1]] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int64()),
                 pa.array([s[2] for s in flat], pa.int64()), pa.array([s[3] for s in flat], pa.float64())], SPAN.names,
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.ListArray.from_arrays(pa.array(ends), items)], names)

    return docs_read.mapInArrow(scan, T.StructType([docs.schema[c] for c in keep] + [T.StructField("spans", T.ArrayType(SPAN))]))
