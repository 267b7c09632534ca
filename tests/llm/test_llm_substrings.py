import collections
import hashlib
import random

import numpy as np
import pytest

from ledgerlark.llm import substrings as ss

SCHEMA = "doc_id long, text string, shard string, n_bytes int"


def brute(docs: list[tuple], length: int) -> list[tuple]:
    raw = [((1 << 70) if i is None else i, (t or "").encode(), i) for i, t in docs]
    first: dict[bytes, int] = {}
    for i, b, _ in raw:
        for j in range(len(b) - length + 1):
            s = b[j : j + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b, doc in raw:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j : j + length]] < i:
                gone[j : j + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def documents(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    shared = [make(n) for n in (18, 19, 20, 25, 60, 200)]
    docs = [None, "", "x", "a" * 300, "a" * 250, "ab" * 150, "ba" * 100]
    for _ in range(60):
        parts = [make(rng.randrange(0, 80))]
        for _ in range(rng.randrange(0, 4)):
            s = rng.choice(shared)
            cut = rng.randrange(len(s))
            parts += [s[cut:] if rng.random() < 0.3 else s, make(rng.randrange(0, 30))]
        docs.append("".join(parts))
    docs += [docs[9], docs[9], shared[5], "z" * 1000 + shared[5]]
    rng.shuffle(docs)
    rows = list(zip(rng.sample(range(-50, 5000), len(docs)), docs))
    return rows + [rows[3], (rows[5][0], shared[4]), (None, shared[5]), (None, shared[5])]


def test_same_as_all_strings(spark, monkeypatch):
    monkeypatch.setattr(ss, "SHARD_BYTES", 1500)
    monkeypatch.setattr(ss, "ANCHORS", 300)
    monkeypatch.setattr(ss, "GATHERED", 200)
    for seed, length, k in ((1, 20, 8), (2, 20, 20), (3, 13, 5)):
        docs = documents(seed)
        df = spark.createDataFrame([(*d, "clash", 0) for d in docs], SCHEMA).repartition(3)
        got = ss.remove_repeats(df, length, k).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(docs, length), (seed, length, k)


def test_kept_text_and_production_length(spark):
    passage = "".join(random.Random(1).choice("abcdefgh ") for _ in range(120))
    docs = [(2, f"first {passage} end"), (1, passage[5:80]), (3, f"{passage}{passage}")]
    df = spark.createDataFrame([(*d, "", 0) for d in docs], SCHEMA)
    got = ss.remove_repeats(df, kept_text=True).collect()
    assert sorted(tuple(r)[:-1] for r in got) == brute(docs, 50)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_common_prefixes_on_the_transform():
    rng = np.random.default_rng(5)
    for n, size in ((1, 3), (50, 2), (300, 3), (400, 1)):
        symbols = np.append(rng.integers(1, size + 1, n), 0).astype(np.uint16)
        for length in (1, 4, 9):
            order = ss.bounded_order(symbols, length)
            text = symbols.tolist()
            keys = [tuple(text[i : i + length]) for i in order]
            assert keys == sorted(keys)
            whole = [len(k) == length for k in keys]
            wanted = [j > 0 and whole[j] and keys[j] == keys[j - 1] for j in range(len(keys))]
            found = ss.equal_from(symbols, order, length)
            assert [bool(f) and w for f, w in zip(found, whole)] == wanted


@pytest.mark.parametrize("length, k", [(9, 4), (10, 4), (50, 20)])
def test_contexts_that_meet_no_other(length, k):
    """Contexts of one anchor: who shares a string with another is found, most others are left out."""
    rng = random.Random(length)
    side, anchor = length - k, "x" * k
    contexts = set()
    for _ in range(300):
        left, right = ("".join(rng.choice("ab" if rng.random() < 0.2 else "c") for _ in range(side)) for _ in "lr")
        cut, stop = rng.choice([0, 0, 0, side // 3]), rng.choice([side, side, side - side // 4])
        contexts.add(((left[cut:] + anchor + right[:stop]).encode(), side - cut))
    contexts = [c for c in sorted(contexts) if len(c[0]) >= length]

    def strings(context: bytes, place: int) -> set:
        return {(context[i : i + length], place - i) for i in range(len(context) - length + 1) if i <= place <= i + length - k}

    held = collections.Counter(s for c in contexts for s in strings(*c))
    meets = ss._meeting([c + bytes((p,)) for c, p in contexts], length, k)
    for c, m in zip(contexts, meets.tolist()):
        assert m or all(held[s] == 1 for s in strings(*c))
    alone = [bytes(rng.randrange(97, 123) for _ in range(2 * side + k)) + bytes((side,)) for _ in range(50)]
    assert not ss._meeting(alone, length, k).any()


def test_empty_table(spark):
    assert ss.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ss.remove_repeats(spark.createDataFrame([(1, None, "", 0)], SCHEMA)).head().n_bytes == 0
