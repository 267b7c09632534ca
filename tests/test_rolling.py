import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import amounts, rolling
from ledgerlark.operators.amounts import Layout

METHODS = [rolling.BY_ROW, rolling.BY_SECOND, rolling.BY_BLOCK]
SCHEMA = "id int, user_id int, sec bigint, amount double"


def brute_force(rows, spans):
    """Expected (count, sum, average) per id and span, straight from the definition."""
    found = {}
    for i, user, sec, _ in rows:
        for name, span in spans.items():
            if sec is None:
                frame = [r for r in rows if r[1] == user and r[2] is None]
            else:
                frame = [
                    r for r in rows if r[1] == user and r[2] is not None and sec - span <= r[2] <= sec
                ]
            values = [r[3] for r in frame if r[3] is not None]
            total = sum(values) if values else None
            mean = total / len(values) if values else None
            found[i, name] = (len(frame), total, mean)
    return found


def result(df, spans, **how):
    rolled = rolling.add_rolling(df, second="sec", spans=spans, **how)
    found = {}
    for r in rolled.collect():
        for s in spans:
            found[r["id"], s] = tuple(
                r[f"u_{m}_{s}"] for m in ("txn_cnt", "amt_sum", "amt_avg")
            )
    return found


def close(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b or math.isclose(a, b, rel_tol=1e-12)


def check(spark, rows, spans, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found, wanted = result(df, spans, **how), brute_force(rows, spans)
    assert found.keys() == wanted.keys()
    for k in wanted:
        assert all(close(a, b) for a, b in zip(found[k], wanted[k])), (k, found[k], wanted[k])


@pytest.mark.parametrize("method", METHODS)
def test_edges_ties_and_nulls(spark, method):
    rows = [
        (1, 1, 0, 1.0),
        (2, 1, 0, 2.0),
        (3, 1, 3600, 4.0),
        (4, 1, 3601, 8.0),
        (5, 1, 86400, 16.0),
        (6, 1, 86401, 32.0),
        (7, 2, 10, None),
        (8, 2, 20, 5.5),
        (9, None, 10, 1.25),
        (10, None, 11, 2.5),
        (11, 3, None, 7.0),
        (12, 3, None, 9.0),
        (13, 3, 5, 11.0),
        (14, 4, -50, 3.0),
        (15, 4, 40, 3.5),
        (16, None, None, 1.0),
    ]
    check(spark, rows, rolling.SPANS, method=method)


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("chunk", [50, 1000, 100000])
def test_random_rows_in_chunks_shorter_and_longer_than_the_spans(spark, method, chunk):
    draw = random.Random(chunk)
    rows = [
        (
            i,
            draw.choice([1, 1, 1, 2, 3, None]),
            draw.choice([None] + [draw.randrange(-500, 3000)] * 20),
            draw.choice([None] + [draw.uniform(0, 10000)] * 8),
        )
        for i in range(400)
    ]
    spans = {"a": 0, "b": 60, "c": 700}
    check(spark, rows, spans, method=method, chunk_seconds=chunk)


@pytest.mark.parametrize("method", METHODS)
def test_amounts_that_are_not_numbers(spark, method):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, 1, 0, 1.0),
        (2, 1, 100, inf),
        (3, 1, 5000, 2.0),
        (4, 1, 9000, -inf),
        (5, 1, 9001, inf),
        (6, 2, 0, nan),
        (7, 2, 10, 1.0),
        (8, 2, 100000, 2.0),
    ]
    check(spark, rows, rolling.SPANS, method=method)


def test_one_user_with_most_rows_is_split_from_the_others(spark):
    draw = random.Random(1)
    rows = [
        (i, 1 if i % 3 else draw.randrange(2, 20), draw.randrange(0, 400), draw.uniform(0, 100))
        for i in range(900)
    ]
    for method in METHODS:
        check(spark, rows, {"a": 30}, method=method, chunk_seconds=100)


def exact(values):
    """The nearest double to the sum of the values' shortest decimals."""
    return float(sum(Fraction(repr(v)) for v in values))


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize(
    "given",
    [
        [701.6, 701.6, 0.1, 0.2, 0.3, -0.1, 1034.8],
        [1e15, -2e15, 7.25, 5e17, 1e-17, -3e25],
        [1e300, 1e300, -1e300, 0.01, 1e-30, 1e-30, 1e-23, 1e-23, 1e-23, 5e-324, 1.7e308],
        [123456789.125, 1e-7, 0.30000000000000004, 3.3333333333333335, None],
        [float(2**53), 1.0, 1.0, 9007199254740993.0],
    ],
)
def test_sums_are_exact_at_any_size(spark, method, given):
    """Every amount alone, all neighbours together, and what is left once a large one has gone."""
    rows = [(i, 1, i * 2, v) for i, v in enumerate(given)] + [(100 + i, 2, i, v) for i, v in enumerate(given[::-1])]
    spans = {"one": 0, "two": 2, "all": 1000}
    found = result(spark.createDataFrame(rows, SCHEMA).repartition(3), spans, method=method, chunk_seconds=1000)
    for i, user, sec, _ in rows:
        for name, span in spans.items():
            frame = [r[3] for r in rows if r[1] == user and sec - span <= r[2] <= sec and r[3] is not None]
            total = found[i, name][1]
            # Limbs far apart are rounded one by one: the last binary digit may be off.
            assert total is None if not frame else math.isclose(total, exact(frame), rel_tol=2.3e-16), (i, name)
            if len(set(frame)) == 1 and frame:
                assert total == exact(frame)


def test_layouts(spark):
    def layout(values):
        df = spark.createDataFrame([(v,) for v in values], "amount double")
        return amounts.find_layout(df, "amount")

    assert layout([1.25, 3.0, -7.5]) == Layout((-2,), True, False, False)
    assert layout([0.0, None, 10.0]) == Layout((-2,), True, True, False)
    assert layout([]) == Layout((-2,), True, False, False)
    assert layout([float("nan"), 0.001]) == Layout((-3,), True, False, True)
    assert layout([1e12 + 0.5, 1e-9]) == Layout((-9,), False, False, False)
    wide = layout([1e300, 0.01, 1e-30])
    assert len(wide.units) == 3 and not wide.whole
    wrong = rolling.add_rolling(spark.createDataFrame([(1, 1, 1, 0.125)], SCHEMA), second="sec", layout=Layout((-2,), True, False, False))
    with pytest.raises(Exception, match="does not fit the layout"):
        wrong.collect()


def test_blocks_deal_out_one_user(spark):
    """A third of all rows is one user's within an hour or has no time at all; every cell stays small."""
    rows = spark.range(30_000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2).cast("int").alias("user_id"),
        F.when(F.col("id") % 6 != 3, F.col("id") % 3600).alias("sec"),
        (F.col("id") % 7 / 10).alias("amount"),
    )
    events = rolling._events(rows.withColumn("_n", F.lit(1)), "user_id", "sec", ["_n"], {"a": 30}, 60)
    cells = events.groupBy("user_id", "_cell", "_salt").count().agg(F.max("count")).head()[0]
    assert cells < 600
    how = dict(second="sec", spans={"a": 30, "b": 900})
    a = rolling.add_rolling(rows, method=rolling.BY_BLOCK, chunk_seconds=60, **how)
    assert a.exceptAll(rolling.add_rolling(rows, method=rolling.BY_ROW, **how)).count() == 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_a_span_longer_than_the_shortest_chunk(spark):
    rows = [(i, 1, i * 400000, float(i)) for i in range(60)]
    check(spark, rows, {"30d": 30 * 86400})


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rolling.add_rolling(df, second="sec").count() == 0


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        rolling.add_rolling(spark.createDataFrame([], SCHEMA), second="sec", method="magic")


def test_per_second_sums_shrink_before_the_shuffle(spark):
    df = spark.range(20000).select(
        F.col("id").cast("int").alias("id"),
        F.lit(1).alias("user_id"),
        (F.col("id") % 10).alias("sec"),
        F.lit(1.0).alias("amount"),
    )
    rolled = rolling.add_rolling(df, second="sec", spans={"a": 3}, method=rolling.BY_SECOND)
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert rolled.groupBy("sec").agg(F.max("u_txn_cnt_a")).count() == 10
