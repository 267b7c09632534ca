from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, _extra int"


def filled(sizes: dict, weights=(5, 2, 1), share=Fraction(3, 2), epochs=2) -> dict:
    """Clamp and share again, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_names, target = share * sum(sizes.values()), set(names), {}
    while open_names:
        total = sum(weight[s] for s in open_names)
        over = [s for s in open_names if left * weight[s] / total > epochs * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_names}
        for s in over:
            target[s] = Fraction(epochs * sizes[s])
        left -= sum(target[s] for s in over)
        open_names -= set(over)
    return target


def test_targets_and_taken(spark):
    words = {"a": [3, 400, 12] * 30, "b": [50] * 10, "é": [1], "z": [0, 0], None: [7, 9, 1000]}
    rows, n = [], 0
    for source, sizes in words.items():
        for size in sizes:
            rows.append((n, source, " ".join(["w"] * size), "clash", 1))
            n += 1
    rows += [(n, "b", None, "clash", 1), (None, "b", "\t", "clash", 1), rows[0], rows[0]]
    words["a"] += [3, 3]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows) and "_extra" in out[0] and "text" in out[0]
    wanted = filled({s: sum(x) for s, x in words.items()})
    for source, target in wanted.items():
        mine = [r for r in out if r.source == source]
        assert all(r.target == pytest.approx(float(target)) and r.source_size == sum(words[source]) for r in mine)
        assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in mine)
        taken = sum(r.taken for r in mine)
        assert abs(taken - float(target)) <= max(words[source]) / 2
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.source or "", r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    one = mixing.mix(spark.createDataFrame([(1, None, None, "", 0)], SCHEMA)).head()
    assert (one["size"], one.taken, one.target) == (0, 0, 0.0)


def test_repeats_are_whole(spark):
    df = spark.createDataFrame([(i, "s", "w " * 10, "", 0) for i in range(40)], SCHEMA)
    got = mixing.mix(df, weights=(1,)).agg(F.sum("taken"), F.min("repeats"), F.max("repeats")).head()
    assert tuple(got) == (600, 1, 2)
