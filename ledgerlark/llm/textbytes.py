"""Texts of an Arrow batch as one byte array, for vectorised work inside tasks."""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone and whole.
PIECE = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece has at most ``most`` bytes of text (or one row) and ``rows`` rows.

    After the last one a reused worker gives back the memory it no longer needs.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = min(max(at + 1, int(np.searchsorted(ends, done + most, "right"))), at + rows)
            yield batch.slice(at, to - at)
            at = to
    _powers.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and the offset of every text with the end of the last; a null text is empty."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


# Fixed values of the word hash: an odd multiplier, its inverse modulo 2^64, a mixing constant.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(32))


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32

#: Where words end: at ASCII white space, or at anything that is not an ASCII letter or beyond ASCII.
WHITE, NOT_LETTER = _WHITE, ~_LETTERS


def _values() -> np.ndarray:
    """A 64-bit value per byte, the same for both cases of A-Z."""
    return mixed((_FOLD + 1).astype(np.uint64) * np.uint64(_MIX >> np.uint64(1)))


with np.errstate(over="ignore"):
    _VALUE = _values()


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = WHITE, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and 64-bit hash of every word, A-Z and a-z alike; words do not span texts.

    ``apart`` says it per byte value; with a ``kind`` per byte it says it per byte, and a word also ends
    where the kind changes, unless to 4 (inside a character), and before every 3.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~apart[data] if kind is None else ~apart
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    if kind is not None:
        first[1:n] |= ((kind[1:] != kind[:-1]) & (kind[1:] != 4)) | (kind[1:] == 3)
    begins = np.flatnonzero(inside[:n] & (first[:n] | ~np.concatenate(([False], inside[: n - 1]))))
    ends = np.flatnonzero(inside[:n] & (first[1:] | ~inside[1:])) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data] * _power(_BASE, n), out=sums[1:])
        hashes = (sums[ends] - sums[begins]) * _power(_INVERSE, n)[begins]
    return begins, ends, mixed(hashes)


def beginnings(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of at least ``size`` bytes, by number, and hashes of their first ``size`` bytes."""
    long = np.flatnonzero(ends - begins >= size)
    h = np.full(len(long), size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = h * np.uint64(_BASE) + _VALUE[data[begins[long] + i]]
    return long, mixed(h)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i])
    return out


def owner(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The index of the text that holds each position."""
    return np.searchsorted(offsets, positions, "right") - 1
