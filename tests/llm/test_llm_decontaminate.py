import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.llm import decontaminate as dc

DOCS = "doc_id long, text string, score string, item_id int"
ITEMS = "item_id long, text string, extra int"


def words(rng, n, prefix="w"):
    return [f"{prefix}{''.join(rng.choice('abcdefgh') for _ in range(5))}" for _ in range(n)]


def slow_score(item, text):
    """Smith-Waterman with +1, -1 and gaps of -1."""
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_is_the_definition():
    rng = np.random.default_rng(1)
    items = rng.integers(2, 6, (50, 12)).astype(np.uint64)
    windows = rng.integers(2, 6, (50, 30)).astype(np.uint64)
    sizes = rng.integers(3, 13, 50)
    for i, n in enumerate(sizes):
        items[i, n:] = 1
    score, begin, end = dc.align(items, windows, sizes)
    for k in range(50):
        assert score[k] == slow_score(items[k, : sizes[k]], windows[k])
        assert score[k] == slow_score(items[k, : sizes[k]], windows[k, begin[k] : end[k]])


def test_copies_edits_and_clean_texts(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, 30))) for i in range(12)] + [(50, None), (51, "too short"), (52, "")]
    filler = lambda n: words(rng, n, "f")
    docs, truth = [], set()
    for d in range(120):
        text = filler(60)
        if d % 3 == 0:
            item = d // 3 % 12
            copy = items[item][1].split()
            for e in range(d % 4):  # edited copies
                copy[7 * e + 3] = "edited"
            if d % 2:
                del copy[10]
            text[20:20] = [w.upper() + "," for w in copy]
            truth.add((d, item))
        docs.append((d, " ".join(text), "clash", 0))
    docs += [(500, None, "", 0), (501, "", "", 0), docs[0], (502, " ".join(filler(20000)) + " " + items[3][1], "", 0)]
    truth.add((502, 3))
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    bench = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    got = dc.find(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth
    assert sum(r.doc_id == 0 for r in got) == 2  # the repeated row
    text = {d[0]: d[1] for d in docs}
    for r in got:
        passage = text[r.doc_id].encode()[r.begin : r.end].decode().lower()
        assert passage.split()[0].strip(",") in items[r.item_id][1] and 0.4 <= r.score <= 1
    kept = dc.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d[0] for d in docs} - {d for d, _ in truth})


def test_a_leak_in_most_documents_is_found(spark):
    rng = random.Random(3)
    item = " ".join(words(rng, 20))
    docs = [(d, " ".join(words(rng, 10, "f")) + " " + item * (d % 5 > 0), "", 0) for d in range(100)]
    got = dc.find(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(7, item, 0)], ITEMS))
    assert {r.doc_id for r in got.collect()} == {d for d in range(100) if d % 5}


def test_groups_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, 25)), 0) for i in range(20)]
    docs = [(d, " ".join(words(rng, 5, "f")) + " " + items[d % 20][1] + " " + items[d % 7][1], "", 0) for d in range(40)]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, dc.find(*frames).collect()))
    monkeypatch.setattr(dc, "PAIRS", 1)
    assert sorted(map(tuple, dc.find(*frames).collect())) == whole
    assert {r[:2] for r in whole} == {(d, i) for d in range(40) for i in (d % 20, d % 7)}


def test_every_script_digits_and_short_items(spark):
    han = "天地玄黄宇宙洪荒日月盈昃辰宿列张"
    items = [("sum", "12 + 34 = 46; 7 * 8 = 56"), ("han", han), (None, "Quokka Numbat"), ("one", "plain"), ("e", "été à la plage, déjà vu")]
    docs = [
        (1, "x y 12 + 34 = 46; 7 * 8 = 56 z"),
        (2, f"前文，{han}。后文"),
        (3, f"前文，{han[:7]}啊{han[8:]}。"),
        (4, "a quokka, numbat b"),
        (5, "quokka and numbat, plain; 12 of 34"),
        (6, "ÉTÉ à la plage... déjà"),
        (7, "été à la plage déjà vu"),
        (None, "quokka numbat"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row0": F.lit(1), "picked": F.lit("x"), "gram": F.lit(0)})
    bench = spark.createDataFrame(items, "item_id string, text string").withColumns({"words": F.lit(1), "item": F.lit(2)})
    got = {(r.doc_id, r.item_id): (r.score, r.begin, r.end) for r in dc.find(frame, bench).collect()}
    assert set(got) == {(1, "sum"), (2, "han"), (3, "han"), (4, None), (6, "e"), (7, "e"), (None, None)}
    assert got[2, "han"] == (1.0, len("前文，".encode()), len(f"前文，{han}".encode()))
    assert got[3, "han"][0] == 14 / 16 and got[4, None] == (1.0, 2, 16)
    kept = dc.clean(frame, bench)
    assert kept.columns == frame.columns and [r.doc_id for r in kept.collect()] == [5]


def test_seeds_are_the_rare_ones_that_the_texts_hold(spark):
    items = [(1, "a b c d e f g h i j"), (2, "never seen in any of the texts at all")]
    docs = [(d, "a b c d " + "x" * d + " h i j") for d in range(20)] + [(90, "a b c d e f g h"), (91, "f g h i j")]
    rows = dc.keyed(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id")
    known = dc.known_items(spark.createDataFrame(items, "item_id long, text string"), "item_id", dc.SCORE)
    rare = dc.seeds(rows, known)
    # Four of ten words are needed, so two of the nine pairs may go: of the five most frequent ones.
    places = {r.place for r in rare.collect()}
    assert len(places) == 7 and {3, 4, 5, 6} <= places
    assert {r.item_id for r in rare.select("item").distinct().join(known, "item").collect()} == {1}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d", "", 0)], DOCS), spark.createDataFrame([], ITEMS)
    assert dc.find(docs, items).count() == 0 and dc.clean(docs, items).count() == 1
    full = spark.createDataFrame([(1, "a b c d", 0)], ITEMS)
    assert dc.find(docs.filter(F.lit(False)), full).count() == 0
    assert dc.clean(docs.filter(F.lit(False)), full).count() == 0


def test_edited_copies_are_those_of_brute_force(spark):
    rng = random.Random(5)
    sizes = [20, 38, 12, 20, 38, 25]
    items = [words(rng, n) for n in sizes]
    docs = []
    for d in range(240):
        item, step = items[d % 6], 4 + d // 6 % 2
        if d % 4 == 3:  # words at random, as many
            copy = [w if rng.random() > 1 / step else "edited" for w in item]
        else:
            copy = ["edited" if (i + d) % step == 0 else w for i, w in enumerate(item)]
        if d % 4 == 1:  # words put in besides
            for at in rng.sample(range(len(copy)), len(copy) // 4):
                copy.insert(at, "more")
        docs.append(words(rng, 30, "f") + copy + words(rng, 30, "f"))
    truth = {}
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            score = slow_score(item, text)
            if score >= 0.4 * len(item):
                truth[d, i] = score / len(item)
    frame = spark.createDataFrame([(d, " ".join(t), "", 0) for d, t in enumerate(docs)], DOCS)
    bench = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(items)], ITEMS)
    got = {(r.doc_id, r.item_id): r.score for r in dc.find(frame, bench).collect()}
    assert got == truth and len(truth) > 100
    assert dc.clean(frame, bench).count() == len(docs) - len({d for d, _ in truth})
