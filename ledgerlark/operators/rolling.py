"""Trailing event-time aggregates per user: count, sum and average over ``[t - span, t]``.

Both ends are inclusive and rows of the same second see each other.

One window per user would put a user's whole history into one task. Here time is cut, and (user, piece of
time) is the unit of work, called a cell. Three ways compute a cell:

``by_row``     sends a row to the cell of its week and, if a later frame can still reach it, to the next one;
               a frame is the difference of two running sums. One shuffle, which moves every row once.
``by_second``  first sums up per second, on the map side before the shuffle, which leaves at most one row
               per second however many rows a second has. The results are joined back to the rows on
               (user, second); adaptive execution splits a skewed key.
``by_block``   is for users that are hot within a week. A row enters a frame at its second and leaves it one
               second after the span has passed. Both are events: one adds the row's amount, the other takes
               it away, and what a frame holds is the sum of all events so far. Cells are hours. The
               events of a cell are added up first, before the shuffle as far as possible; sums over a
               user's cells in order say what every cell starts with, and that is an event like the others,
               put before those of its cell. Rows are moved once, with a slim event for each span; nothing is
               joined back, and a user with a third of all rows is as many cells as there are hours. On
               evenly spread rows this takes two to three times as long as ``by_row``.

The way is the caller's choice, nothing is sized or switched at run time. Rows without a time are peers of each
other and of no other row; ``by_block`` deals them out over ``SALTS`` cells, each starting with what the others
hold.

Amounts are added up as whole numbers (``operators.amounts``), so a sum depends neither on the way nor on the
order in which rows arrive, and an amount leaves nothing behind when it leaves a frame. How they are counted
is found by one pass over the amounts' column, or given as ``layout``; then everything is lazy.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.amounts import Layout, find_layout, limbs, total

SPANS = {"1h": 3600, "24h": 86400}
#: A cell of ``by_row`` and ``by_second``, and one of ``by_block``.
CHUNK_SECONDS, BLOCK_SECONDS = 7 * 86400, 3600
SALTS = 64

BY_ROW, BY_SECOND, BY_BLOCK = "by_row", "by_second", "by_block"

_CELL, _SALT, _OWN, _AT = "_cell", "_salt", "_own", "_at"


def _events(rows: DataFrame, key: str, second: str, measures: list[str], spans: dict[str, int], block: int) -> DataFrame:
    """Every row, and for each span the event of its leaving, which carries only what the sums need."""
    passed = [0, *[span + 1 for span in spans.values()]]
    later = F.element_at(F.array(*[F.lit(p).cast("bigint") for p in passed]), F.col(_OWN) + 1)
    each = F.explode(F.when(F.col(second).isNull(), F.array(F.lit(0))).otherwise(F.array(*[F.lit(k) for k in range(len(passed))])))
    events = rows.select("*", each.alias(_OWN))
    own = F.col(_OWN) == 0
    at = F.col(second) + later
    kept = [F.when(own, F.col(c)).alias(c) for c in rows.columns if c not in (key, *measures)]
    moved = [
        F.when(own, F.col(m)).when(F.col(_OWN) == k, -F.col(m)).alias(f"{m}_{name}")
        for k, name in enumerate(spans, 1)
        for m in measures
    ]
    salt = F.when(F.col(second).isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return events.select(key, *kept, at.alias(_AT), F.floor(at / F.lit(block)).alias(_CELL), salt.alias(_SALT), own.alias(_OWN), *moved)


def _starts(events: DataFrame, key: str, sums: list[str], block: int) -> DataFrame:
    """What every cell starts with, as an event at its first second."""
    cells = events.groupBy(key, _CELL, _SALT).agg(*[F.sum(s).alias(s) for s in sums])
    timed = F.col(_CELL).isNotNull()
    # Cells without a time come apart from the others, and each starts with all the others.
    group = Window.partitionBy(key, timed)
    before = group.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    start = [F.when(timed, F.sum(s).over(before)).otherwise(F.sum(s).over(group) - F.coalesce(s, F.lit(0))).alias(s) for s in sums]
    return cells.select(key, (F.col(_CELL) * block).alias(_AT), _CELL, _SALT, F.lit(False).alias(_OWN), *start)


def _in_blocks(rows: DataFrame, key: str, second: str, measures: list[str], spans: dict[str, int], block: int) -> DataFrame:
    """The rows with ``<measure>_<span>``: the sum of the measure over the rows of the frame."""
    sums = [f"{m}_{name}" for name in spans for m in measures]
    events = _events(rows, key, second, measures, spans, block)
    both = events.unionByName(_starts(events, key, sums, block), allowMissingColumns=True)
    upto = Window.partitionBy(key, _CELL, _SALT).orderBy(_AT).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = both.withColumns({s: F.sum(s).over(upto) for s in sums})
    return summed.where(_OWN).drop(_OWN, _AT, _CELL, _SALT)


def _in_chunks(rows: DataFrame, key: str, second: str, measures: list[str], spans: dict[str, int], chunk: int) -> DataFrame:
    """As ``_in_blocks``; a frame is the difference of two running sums of its cell."""
    chunk = max(chunk, *spans.values())
    first = F.floor(F.col(second) / F.lit(chunk))
    last = F.floor((F.col(second) + F.lit(max(spans.values()))) / F.lit(chunk))
    # A row without a time stays in a cell of its own.
    spread = rows.withColumn(_CELL, F.explode_outer(F.sequence(first, last)))
    spread = spread.withColumn(_OWN, F.col(_CELL).eqNullSafe(first))
    # Copies sent to the next cell carry only what the sums need.
    needed = [key, second, *measures]
    carried = [F.when(F.col(_OWN), F.col(c)).alias(c) for c in rows.columns if c not in needed]
    cells = spread.select(*needed, _CELL, _OWN, *carried)
    ordered = Window.partitionBy(key, _CELL).orderBy(second)
    frames = {"now": ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)}
    for name, span in spans.items():
        frames[f"gone_{name}"] = ordered.rangeBetween(Window.unboundedPreceding, -(span + 1))
    running = {f"{m}_{frame}": F.sum(m).over(w) for frame, w in frames.items() for m in measures}
    summed = cells.withColumns(running).where(_OWN)
    # Rows without a time are peers of each other only: nothing leaves their frame.
    inside = {
        f"{m}_{name}": F.expr(f"coalesce(`{m}_now`, 0) - if(`{second}` is null, 0, coalesce(`{m}_gone_{name}`, 0))")
        for name in spans
        for m in measures
    }
    return summed.withColumns(inside)


def _features(spans: dict[str, int], prefix: str, measures: list[str], layout: Layout) -> dict[str, Column]:
    found = {}
    for name in spans:
        summed, valued = total({m: f"coalesce(`{m}_{name}`, 0)" for m in measures}, layout)
        found[f"{prefix}_txn_cnt_{name}"] = F.col(f"_n_{name}")
        found[f"{prefix}_amt_sum_{name}"] = F.expr(summed)
        found[f"{prefix}_amt_avg_{name}"] = F.expr(f"{summed} / nullif({valued}, 0)")
    return found


def _finished(summed: DataFrame, columns: list[str], spans, prefix, measures, layout) -> DataFrame:
    features = _features(spans, prefix, measures, layout)
    return summed.select(*columns, *[c.alias(n) for n, c in features.items()])


def _by_row(df, key, second, spans, prefix, size, layout, measures) -> DataFrame:
    summed = _in_chunks(df.withColumns(measures), key, second, list(measures), spans, size)
    return _finished(summed, df.columns, spans, prefix, list(measures), layout)


def _by_block(df, key, second, spans, prefix, size, layout, measures) -> DataFrame:
    summed = _in_blocks(df.withColumns(measures), key, second, list(measures), spans, size)
    return _finished(summed, df.columns, spans, prefix, list(measures), layout)


def _by_second(df, key, second, spans, prefix, size, layout, measures) -> DataFrame:
    per_second = df.groupBy(key, second).agg(*[F.sum(m).alias(name) for name, m in measures.items()])
    summed = _in_chunks(per_second, key, second, list(measures), spans, size)
    named = [F.col(k).alias(f"_at_{k}") for k in (key, second)]
    seconds = _finished(summed, named, spans, prefix, list(measures), layout)
    same = [df[k].eqNullSafe(seconds[f"_at_{k}"]) for k in (key, second)]
    return df.join(seconds, same, "inner").drop(*[f"_at_{k}" for k in (key, second)])


_WAYS = {BY_ROW: (_by_row, CHUNK_SECONDS), BY_SECOND: (_by_second, CHUNK_SECONDS), BY_BLOCK: (_by_block, BLOCK_SECONDS)}


def add_rolling(
    df: DataFrame,
    *,
    second: str,
    key: str = "user_id",
    amount: str = "amount",
    spans: dict[str, int] | None = None,
    prefix: str = "u",
    method: str = BY_ROW,
    chunk_seconds: int | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Adds ``<prefix>_txn_cnt_<span>``, ``_amt_sum_`` and ``_amt_avg_`` for every span.

    ``second`` names a bigint column of epoch seconds, ``amount`` a numeric one. Results do not depend on
    the length of a cell, which only decides how finely a user's time is dealt out.
    """
    spans = SPANS if spans is None else spans
    if method not in _WAYS:
        raise ValueError(f"method is one of {list(_WAYS)}, not {method!r}")
    layout = layout or find_layout(df, amount)
    way, size = _WAYS[method]
    return way(df, key, second, spans, prefix, chunk_seconds or size, layout, limbs(amount, layout))
