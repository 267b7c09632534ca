"""Doubles as exact numbers that can be added and taken away again.

A running sum of doubles keeps the rounding of every value that has ever entered it. Sums here are taken of
whole numbers: a double stands for its shortest decimal text, digits times a power of ten, and values are
counted in units of the lowest place that occurs, as bigints if they fit, else as decimals of 38 digits.
Where the places of one column lie too far apart for that, there are several such limbs, each with a unit of
its own, and a value enters the one that its last digit belongs to. Adding is exact and independent of order
for every finite double; infinite and not-a-number values are counted.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Limbs are put together from bands of so many decimal places. A shortest decimal has 17 digits at most.
BAND, DIGITS = 6, 17
#: Amounts of whole cents are found, and turned into numbers, without going through text.
CENTS, CENTS_BELOW = -2, 1e12


@dataclass(frozen=True)
class Layout:
    """How a column's amounts are counted: the unit of every limb as a power of ten, lowest first, whether
    bigints hold them, whether some are missing and whether some are infinite or not a number."""

    units: tuple[int, ...] = (CENTS,)
    whole: bool = True
    missing: bool = True
    special: bool = True


def _is_cents(v: Column) -> Column:
    return (F.abs(v) < CENTS_BELOW) & (F.rint(v * 100) / 100 == v)


def _parts(v: Column) -> tuple[Column, Column, Column]:
    """A double's shortest text: mantissa, exponent and number of places behind the point."""
    text = v.cast("string")
    mantissa = F.substring_index(text, "E", 1)
    exponent = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(F.lit(0))
    places = F.length(F.rtrim(F.substring_index(mantissa, ".", -1), F.lit("0")))
    return mantissa, exponent, places


def _finite(v: Column) -> Column:
    # NaN compares as greater than any number.
    return F.abs(v) < float("inf")


def find_layout(df: DataFrame, amount: str) -> Layout:
    """The layout for a column, from one pass over it; the driver receives a single small row."""
    v = F.col(amount).cast("double")
    mantissa, exponent, places = _parts(v)
    number = _finite(v) & (v != 0)
    cents = _is_cents(v)
    place = F.when(number & cents, CENTS).when(number, exponent - places)
    point = F.length(F.substring_index(F.ltrim(mantissa, F.lit("-")), ".", 1))
    top = F.when(number & cents, F.ceil(F.log10(F.abs(v) + 1))).when(number, exponent + point)
    found = df.select(place.cast("int").alias("place"), top.cast("int").alias("top"), _finite(v).alias("finite"), v.isNull().alias("missing"))
    band = F.floor(F.col("place") / BAND).cast("int")
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
    # A double's places lie between -324 and 308, so a bit for each band fits two numbers.
    masks = {"from_one": F.when(band >= 0, bit(band)), "below_one": F.when(band < 0, bit(-1 - band))}
    seen = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("place").alias("low"),
        F.max("top").alias("high"),
        *[F.coalesce(F.bit_or(mask), F.lit(0)).alias(name) for name, mask in masks.items()],
        F.coalesce(F.bool_or("missing"), F.lit(False)).alias("missing"),
        F.coalesce(F.bool_or(~F.col("finite")), F.lit(False)).alias("special"),
    ).head()
    bands = [-1 - k for k in range(63) if seen.below_one >> k & 1] + [k for k in range(63) if seen.from_one >> k & 1]
    return layout_for(seen.n, seen.low, seen.high, bands, seen.missing, seen.special)


def layout_for(rows: int, low: int | None, high: int | None, bands: list[int], missing: bool, special: bool) -> Layout:
    """The layout for so many values with digits in places ``low`` to ``high``, lowest digits in ``bands``."""
    more = len(str(rows)) + 1
    if low is None:
        return Layout((CENTS,), True, missing, special)
    if high - low + more <= 18:
        return Layout((low,), True, missing, special)
    if high - low + more <= 38:
        return Layout((low,), False, missing, special)
    reach = max(BAND, 38 - DIGITS - more - BAND)
    units: list[int] = []
    for band in sorted(bands):
        if not units or band * BAND + BAND - units[-1] > reach:
            units.append(band * BAND)
    return Layout(tuple(units), False, missing, special)


def _checked(units: Column, back: Column, v: Column) -> Column:
    fits = F.when(back == v, units)
    return F.when(v.isNull() | ~_finite(v), None).otherwise(
        F.coalesce(fits, F.raise_error(F.concat(F.lit("amount does not fit the layout: "), v.cast("string"))).cast("bigint"))
    )


def limbs(amount: str, layout: Layout) -> dict[str, Column]:
    """Columns whose sums hold everything that there is to know of the amounts added up."""
    v = F.col(amount).cast("double")
    found: dict[str, Column] = {"_n": F.lit(1).cast("bigint")}
    if layout.missing:
        found["_valued"] = v.isNotNull().cast("bigint")
    if layout.special:
        found["_above"] = F.coalesce(v == float("inf"), F.lit(False)).cast("bigint") + F.coalesce(F.isnan(v), F.lit(False)).cast("bigint")
        found["_below"] = F.coalesce(v == float("-inf"), F.lit(False)).cast("bigint") + F.coalesce(F.isnan(v), F.lit(False)).cast("bigint")
    (first, *rest) = layout.units
    if rest:
        mantissa, exponent, places = _parts(v)
        place = exponent - places
        for k, unit in enumerate(layout.units):
            own = (place >= unit if k else F.lit(True)) & (place < layout.units[k + 1] if k + 1 < len(layout.units) else F.lit(True))
            units = F.concat(mantissa, F.lit("E"), (exponent - unit).cast("string")).cast("decimal(38,0)")
            found[f"_limb{k}"] = F.when(_finite(v) & (v != 0) & own, units).when(v.isNotNull(), F.lit(0).cast("decimal(38,0)"))
    elif layout.whole:
        scale = float(f"1e{abs(first)}")
        scaled = F.rint(v * scale if first < 0 else v / scale)
        back = scaled / scale if first < 0 else scaled * scale
        found["_limb0"] = _checked(scaled.cast("bigint"), back, v)
    else:
        mantissa, exponent, _ = _parts(v)
        units = F.concat(mantissa, F.lit("E"), (exponent - first).cast("string")).cast("decimal(38,0)")
        found["_limb0"] = F.when(_finite(v), units)
    return found


def total(sums: dict[str, str], layout: Layout) -> tuple[str, str]:
    """SQL of the sum as a double, and of the number of values in it, from SQL of the summed limbs.

    The sum is the double nearest to the exact one if its digits lie in one limb. Limbs far apart are rounded
    one by one and added from the lowest, which is off by one in the last binary digit at most.
    """
    valued = sums.get("_valued", sums["_n"])
    if layout.whole and len(layout.units) == 1 and -22 <= layout.units[0] <= 0:
        # Below 2^53 both numbers are exact, so the quotient is the nearest double.
        scale = 10 ** -layout.units[0]
        whole = sums["_limb0"]
        precise = f"double(concat(cast({whole} as string), 'E{layout.units[0]}'))"
        number = f"if(abs({whole}) < 9007199254740992L, cast({whole} as double) / {scale}D, {precise})"
    else:
        each = [f"double(concat(cast(coalesce({sums[f'_limb{k}']}, 0) as string), 'E{unit}'))" for k, unit in enumerate(layout.units)]
        number = " + ".join(each)
    if layout.special:
        above, below = sums["_above"], sums["_below"]
        number = f"""case
            when {above} > 0 and {below} > 0 then double('NaN')
            when {above} > 0 then double('Infinity')
            when {below} > 0 then double('-Infinity')
            else {number} end"""
    return f"if({valued} = 0, null, {number})", valued
