"""Column expressions that several operators share."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
