"""Removing byte strings that an earlier document already holds, by bounded suffix indexes.

A string of ``LENGTH`` bytes is removed if it also begins in a document with a smaller doc_id. No single
task can index all texts, so strings are dealt out by content: every LENGTH-byte string has an anchor, its
``GRAM``-byte substring with the smallest hash (all of equal ones), so equal strings have equal anchors at
equal places.

1. Anchors' hashes, once for each shard of documents, are shuffled by hash; those that two documents hold
   are sent back to their shards. Most text ends here.
2. For the anchors left, the bytes around them (all strings that contain the anchor lie within) are
   shuffled by hash, each distinct context of a shard once, with the smallest doc_id that has it. So a
   passage that very many documents share costs a row for each shard, not for each document.
3. Equal strings in different contexts agree on one side of the anchor in half of the rest of their bytes at
   least. A context that so agrees with no other holds its strings alone: its smallest doc_id is theirs. A
   task indexes the other distinct contexts that meet: suffixes are sorted by their first symbols up to the
   length, and a breadth-first backward extension of intervals on the Burrows-Wheeler transform sets the
   common-prefix values 0, 1, 2, ... of neighbouring suffixes in this order. It stops at LENGTH: positions
   still without a value share LENGTH bytes or more, and runs of them are the classes of equal strings.
   Each class has its smallest doc_id, which goes back to the shards where it is below their own.
4. Shards mark what is to be removed and hash what is left.

Texts are shuffled once, for steps 2 and 4 together.

Defined results: null and empty texts have no bytes. Rows of equal doc_id do not remove each other's
strings. Null doc_ids count as larger than all others and equal to each other. An empty table gives an
empty table. Columns other than the id and the text are not carried.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.textbytes import flat, mixed, owner, pieces
from ledgerlark.session import stored

LENGTH = 50
GRAM = 20
#: Bytes of text, about, in a shard, and anchors, about, that are compared in one task.
SHARD_BYTES = 4 << 20
ANCHORS = 1 << 20
#: Anchors that a task gathers before it hands them on.
GATHERED = 1 << 21
#: Anchors are told apart by their bucket and so many bits more; what meets by chance is compared by bytes later.
SHORT = np.uint64(0xFFFFFFFE)
LAST = np.iinfo(np.int64).max

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_STEP = 0x9FB21C651E98DF25


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` over every w consecutive values, in log2(w) passes."""
    done = 1
    while done * 2 <= w:
        x = pick(x[: len(x) - done], x[done:])
        done *= 2
    return pick(x[: len(x) - (w - done)], x[w - done :]) if w > done else x


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive bytes, built from those of powers of two."""
    with np.errstate(over="ignore"):
        part, size, out, got = _BYTE[data], 1, None, 0
        while True:
            if k & size:
                if out is None:
                    out, got = part, size
                else:  # bytes of this part come before those gathered
                    n = len(data) - got - size + 1
                    out, got = part[:n] * np.uint64(pow(_STEP, got, 1 << 64)) + out[size : size + n], got + size
            if got == k:
                break
            n = len(part) - size
            part, size = part[:n] * np.uint64(pow(_STEP, size, 1 << 64)) + part[size:], size * 2
        out = out ^ (out >> np.uint64(31))
        out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def _short(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and short hash, whose lowest bit is free."""
    return (hashes >> np.uint64(40)) % np.uint64(buckets), (hashes & SHORT).astype(np.uint32)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all strings of ``length`` bytes that lie in one text, and their hashes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = _gram_hashes(data, k)
    rank = (hashes >> np.uint64(32)).astype(np.uint32)
    worst = np.uint32(0xFFFFFFFF)
    for edge in offsets[1:-1]:  # of grams that span texts
        rank[max(0, edge - k + 1) : edge] = worst
    w = length - k + 1
    least = _sliding(rank, w, np.minimum)
    reach = np.zeros(len(least) + 2 * (w - 1), np.uint32)
    reach[w - 1 : w - 1 + len(least)] = least
    at = np.flatnonzero((_sliding(reach, w, np.maximum) == rank) & (rank != worst))
    return at, hashes[at] & ~np.uint64(1)


def bounded_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` symbols (0 to 256), by prefix doubling. Suffixes
    that differ from all others already are not sorted again."""
    n, step = len(symbols), 7
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = key << 9 | padded[i : i + n]
    order, rank, places = np.arange(n), np.zeros(n + 1, np.int64), np.arange(n)
    while True:
        by = np.argsort(key)
        key, suffix = key[by], order[places][by]
        order[places] = suffix
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        rank[suffix] = places[first] + 1
        places = places[~(new & np.append(new[1:], True))]
        if step >= depth or not len(places):
            return order
        suffix = order[places]
        key = rank[suffix] * (n + 2) + rank[np.minimum(suffix + step, n)]
        step *= 2


def equal_from(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For every place in the order, whether the suffix shares ``length`` symbols with the one before.

    Intervals of the order stand for strings; all intervals of one length are extended backwards at once.
    The row after the extended interval gets the string's length as its common prefix, unless it has a
    smaller one, and only then the interval is extended further.
    """
    n = len(symbols)
    before = symbols[order - 1]  # the first suffix is preceded by the last symbol
    by_symbol = np.argsort(before, kind="stable")
    forward = np.empty(n, np.int64)
    forward[by_symbol] = np.arange(n)
    first = before[by_symbol]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        size = hi - lo
        rows = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        to = forward[rows]
        parent = np.repeat(np.arange(len(lo)), size)
        if len(to) > n // 8:
            tag = np.full(n, -1, np.int64)
            tag[to] = parent
            to = np.flatnonzero(tag >= 0)
            parent = tag[to]
        else:
            by = np.argsort(to)
            to, parent = to[by], parent[by]
        new = np.ones(len(to), bool)
        new[1:] = (to[1:] != to[:-1] + 1) | (parent[1:] != parent[:-1]) | (first[to[1:]] != first[to[:-1]])
        begin = np.flatnonzero(new)
        lo, hi = to[begin], to[np.append(begin[1:], len(to)) - 1] + 1
        fresh = ~known[hi]
        lo, hi = lo[fresh], hi[fresh]
        known[hi] = True
        if not len(lo):
            break
    return ~known[:n]


def smallest_holders(contexts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For every string of ``length`` bytes in the contexts, the smallest of the docs of equal strings;
    by context and place, with the place where each context's strings begin."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    symbols = np.zeros(sizes.sum() + len(sizes), np.uint16)
    inner = np.ones(len(symbols), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    symbols[inner] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + 1
    order = bounded_order(symbols, length)
    equal = equal_from(symbols, order, length)
    starts = np.flatnonzero(~equal)
    context = np.repeat(np.arange(len(sizes)), sizes + 1)
    least = np.minimum.reduceat(docs[context[order]], starts)
    found = np.empty(len(symbols), np.int64)
    found[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
    whole = place + length <= sizes[context]
    return found[whole], np.concatenate(([0], np.cumsum(np.maximum(sizes - length + 1, 0))))


class Shard:
    """A shard's documents, in order of doc_id, and the contexts of their shared anchors."""

    def __init__(self, table: pa.Table, shared: np.ndarray, buckets: int, bins: int, length: int, k: int):
        table = table.combine_chunks()
        ids = table.column("doc_id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
        self.null = np.array(ids.is_null())
        self.ids = np.where(self.null, LAST, ids.fill_null(0).to_numpy(zero_copy_only=False)) if len(ids) else np.zeros(0, np.int64)
        order = np.argsort(self.ids, kind="stable")
        self.ids, self.null = self.ids[order], self.null[order]
        texts = table.column("text").combine_chunks().take(pa.array(order)) if len(ids) else pa.array([], pa.string())
        self.data, self.offsets = flat(texts)
        self.length, self.bins = length, {}
        at, hashes = anchors(self.data, self.offsets, length, k)
        if len(shared) and len(at):
            bucket, short = _short(hashes, buckets)
            key = bucket << np.uint64(32) | short
            spot = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
            keep = shared[spot] == key
            at, hashes = at[keep], hashes[keep]
        else:
            at, hashes = at[:0], hashes[:0]
        doc = owner(at, self.offsets)
        begin = np.maximum(at - (length - k), self.offsets[doc])
        end = np.minimum(at + length, self.offsets[doc + 1])
        long = end - begin >= length
        self.begin, self.end, self.doc = begin[long], end[long], doc[long]
        self.bin = ((hashes[long] >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
        raw, place = self.data.tobytes(), (at[long] - self.begin).astype(np.uint8)
        ends = [bytes((p,)) for p in range(256)]
        #: Per bin the distinct contexts, each with the anchor's place as its last byte, in order of first
        #: appearance, so each one's first document is the smallest that has it; and for every anchor the
        #: number of its context.
        self.number = np.zeros(len(self.begin), np.int64)
        for i, (a, b, c, p) in enumerate(zip(self.begin.tolist(), self.end.tolist(), self.bin.tolist(), place.tolist())):
            seen = self.bins.setdefault(c, {})
            self.number[i] = seen.setdefault(raw[a:b] + ends[p], (len(seen), i))[0]

    def first_docs(self, b: int) -> np.ndarray:
        return self.ids[self.doc[[i for _, i in self.bins[b].values()]]]

    def removed(self, earlier: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Marks of bytes to remove; ``earlier`` has for each bin, by context and run of strings, the
        smallest doc_id elsewhere (context, first string, doc_id), for strings that others hold first."""
        change = np.zeros(len(self.data) + 1, np.int64)
        for b, seen in self.bins.items():
            rows = np.flatnonzero(self.bin == b)
            firsts = self.first_docs(b)[self.number[rows]]
            own = self.ids[self.doc[rows]]
            repeat = own > firsts  # all of the context's strings begin in an earlier document here
            np.add.at(change, self.begin[rows[repeat]], 1)
            np.add.at(change, self.end[rows[repeat]], -1)
            if b in earlier and len(earlier[b][0]):
                context, start, stop = earlier[b]
                # What others hold before the first one here, for that first one and rows of its id.
                rows = rows[~repeat]
                lo = np.searchsorted(context, self.number[rows])
                hit = (lo < len(context)) & (context[np.minimum(lo, len(context) - 1)] == self.number[rows])
                rows, lo = rows[hit], lo[hit]
                np.add.at(change, self.begin[rows] + start[lo], 1)
                np.add.at(change, self.begin[rows] + stop[lo] - 1 + self.length, -1)
        return np.cumsum(change[:-1]) > 0


def _shared_anchors(docs: DataFrame, buckets: int, shards: int, length: int, k: int) -> DataFrame:
    """Rows ``shard``, ``payload``: a bucket and short hashes of anchors that at least two documents hold."""
    number = np.uint16 if shards <= 1 << 16 else np.uint32

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            h, shard, doc = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((doc, shard, h))
            h, shard, doc = h[order], shard[order], doc[order]
            same = h[1:] == h[:-1]
            several = np.zeros(len(h), bool)
            several[1:] = same & (doc[1:] != doc[:-1])
            several[:-1] |= several[1:]
            new = np.ones(len(h), bool)
            new[1:] = ~same | (shard[1:] != shard[:-1])
            group = np.cumsum(new) - 1
            flag = np.bincount(group, several) > 0
            bucket, short = _short(h[new], buckets)
            short |= flag.astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            h, shard, bucket = short[order], shard[new][order], bucket[order]
            cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(h))
            columns = [
                pa.array(bucket[cuts[:-1]].astype(np.int32)),
                pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([shard[a:b].astype(number).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "hashes", "shards"])

        total = 0
        for batch in pieces(batches):
            data, offsets = flat(batch.column("text"))
            at, h = anchors(data, offsets, length, k)
            if not len(at):
                continue
            doc = owner(at, offsets)
            held.append((h, batch.column("shard").to_numpy()[doc], doc + total))
            total, size = total + batch.num_rows, size + len(at)
            if size > GATHERED:
                yield flushed()
                held, size = [], 0
        if held:
            yield flushed()

    def compared(table: pa.Table) -> pa.Table:
        bucket = np.array(table.column("bucket")[:1], np.uint32)
        h = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint32)
        shard = np.frombuffer(b"".join(table.column("shards").to_pylist()), number)
        order = np.argsort(h, kind="stable")
        h, shard = h[order], shard[order]
        plain, flag = h & ~np.uint32(1), (h & np.uint32(1)) == 1
        new = np.concatenate(([True], plain[1:] != plain[:-1]))
        group = np.cumsum(new) - 1
        several = (np.bincount(group) > 1) | (np.bincount(group, flag) > 0)
        h, shard = plain[several[group]], shard[several[group]]
        order = np.argsort(shard, kind="stable")
        h, shard = h[order], shard[order]
        cuts = np.append(np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))), len(h)) if len(h) else np.zeros(1, int)
        return pa.table({"shard": pa.array(shard[cuts[:-1]], pa.int32()), "payload": pa.array([bucket.tobytes() + h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    rows = docs.select("shard", "text").mapInArrow(gathered, "bucket int, hashes binary, shards binary")
    return rows.groupBy("bucket").applyInArrow(compared, "shard int, payload binary")


_SENT = pa.schema([("bin", pa.int32()), ("shard", pa.int32()), ("docs", pa.binary()), ("sizes", pa.binary()), ("bytes", pa.binary())])
_RUNS = pa.schema([("shard", pa.int32()), ("bin", pa.int32()), ("payload", pa.binary())])


def _hashes(table: pa.Table) -> np.ndarray:
    found = [np.frombuffer(p, np.uint32).astype(np.uint64) for p, b in zip(table.column("payload").to_pylist(), table.column("bin").to_pylist()) if b is None]
    return np.unique(np.concatenate([*(f[0] << np.uint64(32) | f[1:] for f in found), np.zeros(0, np.uint64)]))


def _meeting(contexts: list[bytes], length: int, k: int) -> np.ndarray:
    """Whether each context, the anchor's place behind it, may share a string that holds the anchor with another."""
    sizes = np.array([len(c) - 1 for c in contexts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    data, half = np.frombuffer(b"".join(contexts), np.uint8), (length - k + 1) // 2
    place = data[begins + sizes].astype(np.int64)
    hashes, meets = _gram_hashes(data, k + half), np.zeros(len(contexts), bool)
    for start in (place - half, place):
        own = np.flatnonzero((start >= 0) & (start + k + half <= sizes))
        _, group, many = np.unique(hashes[(begins + start)[own]], return_inverse=True, return_counts=True)
        meets[own] |= many[group] > 1
    return meets


def _indexed(table: pa.Table, length: int, k: int) -> pa.Table:
    """Contexts that meet in a bin to the runs of their strings that are held earlier elsewhere."""
    rows = [table.column(c).to_pylist() for c in ("shard", "docs", "sizes", "bytes")]
    number: dict[bytes, int] = {}
    sent, firsts = [], []
    for _, docs, sizes, raw in zip(*rows):
        docs, at, mine = np.frombuffer(docs, np.int64), 0, []
        for d, size in zip(docs.tolist(), np.frombuffer(sizes, np.uint16).tolist()):
            i = number.setdefault(raw[at : at + size], len(number))
            at += size
            if i == len(firsts):
                firsts.append(d)
            elif d < firsts[i]:
                firsts[i] = d
            mine.append(i)
        sent.append((docs, np.array(mine, np.int64)))
    contexts, firsts = list(number), np.array(firsts, np.int64)
    meets = _meeting(contexts, length, k)
    starts = np.concatenate(([0], np.cumsum([len(c) - length for c in contexts])))
    least = np.repeat(firsts, np.diff(starts))
    if meets.any():
        some = [c[:-1] for c, m in zip(contexts, meets.tolist()) if m]
        least[np.repeat(meets, np.diff(starts))] = smallest_holders(some, firsts[meets], length)[0]
    out = []
    for docs, mine in sent:
        many = starts[mine + 1] - starts[mine]
        context = np.repeat(np.arange(len(mine)), many)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        earlier = least[starts[mine][context] + place] < docs[context]
        context, place = context[earlier], place[earlier]
        new = np.concatenate(([True], context[1:] != context[:-1])) if len(context) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(context))[: len(first)] - 1
        # All strings of a context hold its anchor, so what the first and the last one span is removed.
        out.append(np.stack([context[first], place[first], place[last] + 1]).astype(np.int32).tobytes())
    b = table.column("bin")[0].as_py()
    return pa.table({"shard": pa.array(rows[0], pa.int32()), "bin": pa.array([b] * len(out), pa.int32()), "payload": pa.array(out, pa.binary())}, schema=_RUNS)


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = GRAM, doc_id: str = "doc_id", kept_text: bool = False) -> DataFrame:
    """Rows ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and ``kept`` (the bytes
    left) if ``kept_text``."""
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = total // SHARD_BYTES + 1
    buckets = 2 * total // (length - k + 2) // ANCHORS + 1
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    shared = stored(_shared_anchors(rows, buckets, shards, length, k), "repeat-anchors")
    shared = shared.select("shard", F.lit(None).cast("int").alias("bin"), "payload")

    def contexts(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shard = Shard(left, _hashes(right), buckets, shards, length, k)
        found = [(b, key[0].as_py(), shard.first_docs(b).tobytes(), np.array([len(c) for c in seen], np.uint16).tobytes(), b"".join(seen)) for b, seen in shard.bins.items()]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), _SENT)] if found else [pa.array([], f.type) for f in _SENT], schema=_SENT)

    def finished(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shard = Shard(left, _hashes(right), buckets, shards, length, k)
        earlier = {}
        for b, payload in zip(right.column("bin").to_pylist(), right.column("payload").to_pylist()):
            if b is not None:
                earlier[b] = tuple(np.frombuffer(payload, np.int32).reshape(3, -1).astype(np.int64))
        gone, at = shard.removed(earlier), shard.offsets
        n = len(shard.ids)
        begins = np.flatnonzero(gone & ~(np.concatenate(([False], gone[:-1])) & ~np.isin(np.arange(len(gone)), at)))
        sums = np.concatenate(([0], np.cumsum(gone)))
        spans = np.bincount(owner(begins, at), minlength=n)
        kept = [shard.data[a:b][~gone[a:b]].tobytes() for a, b in zip(at, at[1:])]
        columns = {
            "doc_id": pa.array(np.where(shard.null, 0, shard.ids), mask=shard.null),
            "n_bytes": pa.array(np.diff(at)),
            "n_removed": pa.array(sums[at[1:]] - sums[at[:-1]]),
            "n_spans": pa.array(spans[:n].astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in kept], pa.string()),
        }
        if kept_text:
            columns["kept"] = pa.array(kept, pa.binary())
        return pa.table(columns)

    # The same grouping of the texts twice in one plan, so that Spark shuffles them once.
    dealt = rows.groupBy("shard")
    sent = dealt.cogroup(shared.groupBy("shard")).applyInArrow(contexts, "bin int, shard int, docs binary, sizes binary, bytes binary")
    runs = sent.groupBy("bin").applyInArrow(lambda t: _indexed(t, length, k), "shard int, bin int, payload binary")
    replies = shared.unionByName(runs).groupBy("shard")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return dealt.cogroup(replies).applyInArrow(finished, schema + ", kept binary" * kept_text)
