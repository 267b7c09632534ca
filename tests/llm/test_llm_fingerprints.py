import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from ledgerlark.llm import fingerprints as prints
from ledgerlark.llm.queries import op4_fingerprints

SCHEMA = "doc_id long, text string, _range int, fp string"


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def fold(values: list[int], seed: int = 42) -> int:
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return signed(seed)


def brute(text: str | None, k: int, w: int) -> list[tuple]:
    tokens = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")]
    if not tokens:
        return []
    if len(tokens) < k:
        whole = 0
        for t in tokens:
            whole = fold([whole, t])
        return [(0, whole)]
    grams = [fold(tokens[i : i + k]) for i in range(len(tokens) - k + 1)]
    w = min(w, len(grams))
    kept = set()
    for s in range(len(grams) - w + 1):
        least = min(grams[s : s + w])
        kept.add(max(i for i in range(s, s + w) if grams[i] == least))
    return [(i, grams[i]) for i in sorted(kept)]


def test_winnow_is_the_definition(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "one two", "a a a a a a a a a a", "x" * 100, "é é b\x1cc d e"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for k, w in ((3, 5), (1, 1), (2, 4)):
        for r in df.select("i", prints.winnow(F.col("text"), k, w).alias("fp")).collect():
            assert [(x.pos, x.hash) for x in r.fp] == brute(texts[r.i], k, w), (k, w, texts[r.i])


def test_shared_runs_share_a_hash(spark):
    run = " ".join(f"r{i}" for i in range(prints.GRAM + prints.WINDOW - 1))
    rows = [(f"a b c d {run} e f", f"{run} z"), ("q", "q")]
    df = spark.createDataFrame(rows, "a string, b string")
    both = F.size(F.array_intersect(prints.winnow(F.col("a"))["hash"], prints.winnow(F.col("b"))["hash"]))
    assert [r[0] > 0 for r in df.select(both).collect()] == [True, True]


def test_next_and_edited(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prints, "RANGE_ROWS", 3)
    rng = random.Random(4)
    ids = rng.sample(range(-1000, 100000), 30)
    texts = {i: " ".join(rng.choice(["é", "b", "cc", "ddd"]) for _ in range(rng.randrange(0, 40))) for i in ids}
    texts[ids[3]] = None
    rows = [(i, t, 0, "clash") for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op4_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(ids, reverse=True)
    assert len(got) == len(ids)
    for i, after in zip(order, order[1:] + order[:1]):
        own, following = texts[i] or "", texts[after] or ""
        tail = len(own) // 3
        edited = own[: len(own) - tail] + following[:tail]
        assert got[i].n_chars == len(own) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for text, near in ((edited, got[i].near_edited), (following, got[i].near_next)):
            a, b = ({h for _, h in brute(t, prints.GRAM, prints.WINDOW)} for t in (own, text))
            assert near == (len(a & b) / len(a | b) if a | b else 1.0)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a", 0, ""), (1, "a", 0, ""), (1, "b", 0, ""), (None, "n", 0, ""), (5, None, 0, "")]
    got = sorted((str(r.doc_id), r.text, r.next_text) for r in prints.with_next(spark.createDataFrame(rows, SCHEMA)).collect())
    assert len(got) == 5 and ("5", "", "n") not in got and ("None", "n", "") in got
    lone = prints.with_next(spark.createDataFrame(rows[:1], SCHEMA)).head()
    assert (lone.text, lone.next_text) == ("a", "a")
    assert prints.with_next(spark.createDataFrame([], SCHEMA)).count() == 0
