import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from ledgerlark.llm import periodic
from ledgerlark.llm.queries import op12_periodic_runs


def plainly(words: list) -> list[tuple[int, int, int]]:
    """All runs, by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, size, q) for (a, size), q in found.items())


def collapsed(words: list[str], runs) -> list[str]:
    gone = {k for a, size, q in runs for k in range(a + q, a + size)}
    return [w for k, w in enumerate(words) if k not in gone]


def texts(seed: int):
    rng = random.Random(seed)
    for n in [*range(14), *(rng.randrange(14, 90) for _ in range(120))]:
        words = [rng.randrange(rng.choice((1, 2, 3, 30))) for _ in range(n)]
        if n > 10 and rng.random() < 0.7:
            a, p = rng.randrange(n), rng.randrange(1, 9)
            words = [words[k] if k < a else words[a + (k - a) % p] if a + p <= n else words[k] for k in range(n)]
        yield words


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_all_periods(seed):
    for words in texts(seed):
        own = periodic.runs_of([*words, 99]).tolist()
        assert own == [list(r) for r in plainly(words)], words


def test_many_texts_share_trees(monkeypatch):
    monkeypatch.setattr(periodic, "TOGETHER", 200)
    several = [np.array(t, np.int64) for t in texts(3)]
    found = periodic.runs_of_texts(several)
    for words, runs in zip(several, found):
        assert runs.tolist() == [list(r) for r in plainly(words.tolist())]


def test_extensions():
    rng = random.Random(4)
    text = [rng.randrange(2) for _ in range(300)] + [7]
    tree = periodic.Extensions(text)
    i, j = np.array([(a, b) for a in range(0, 300, 3) for b in range(300) if a != b]).T
    for a, b, got in zip(i, j, tree.of(i, j)):
        k = 0
        while text[a + k] == text[b + k] and max(a, b) + k < 300:
            k += 1
        assert got == k
    order = sorted(range(301), key=lambda a: text[a:])
    assert np.argsort(tree.place).tolist() == order


def test_long_text_of_one_word():
    (runs,) = periodic.runs_of_texts([np.zeros(60_000, np.int64)])
    assert runs.tolist() == [[0, 60_000, 1]]


def test_query_equals_plain_runs(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(("a", "B", "b", "\té", "x\x0b")) for _ in range(rng.randrange(120))), i, "c") for i in range(400)]
    rows += [(900, None, 1, "c"), (901, "", 1, "c"), (902, " \n\t", 1, "c"), (None, "q " * 9, 1, "c"), rows[3], (903, "w w " * 5000, 1, None)]
    schema = "doc_id long, text string, runs int, collapsed string"
    df = spark.createDataFrame(rows, schema)
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(repr, map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect())))
    wanted = []
    for doc_id, text, _, _ in rows:
        words = (text or "").encode().split()
        n, h = len(words), crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plainly(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        lines = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
        kept = b" ".join(collapsed(words, runs))
        wanted.append((doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                       sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest()))
    assert found == sorted(map(repr, wanted))
    kept = periodic.find(df)
    assert kept.columns == ["doc_id", "text", "runs", "collapsed"]
    assert periodic.find(df.limit(0)).count() == 0
