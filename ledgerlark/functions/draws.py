"""Uniform draws that are a function of (seed, row id, draw name).

Unlike ``rand()`` they do not depend on partitioning or retries, so a lost executor recomputes
the same rows. One md5 digest yields four 32-bit draws.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 4
_HEX = 8


def bits32(digest: Column, lane: int = 0) -> Column:
    """The ``lane``-th group of eight hex digits as a bigint in [0, 2^32)."""
    return F.conv(F.substring(digest, 1 + _HEX * lane, _HEX), 16, 10).cast("long")


def digest(seed: int, block: int, row_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit(block), row_id.cast("string")))


class Draws:
    """Named draws, as columns that :meth:`attach` computes once per row."""

    def __init__(self, names: list[str], seed: int):
        self._names = names
        self._seed = seed
        self.columns = [f"_draw_{n}" for n in names]

    def attach(self, df: DataFrame, row_id: str) -> DataFrame:
        blocks = -(-len(self._names) // LANES)
        digests = [f"_digest{b}" for b in range(blocks)]
        hashed = df.withColumns(
            {c: digest(self._seed, b, F.col(row_id)) for b, c in enumerate(digests)}
        )
        units = {}
        for i, column in enumerate(self.columns):
            block, lane = divmod(i, LANES)
            bits = bits32(F.col(digests[block]), lane)
            units[column] = bits.cast("double") / F.lit(4294967296.0)
        return hashed.withColumns(units).drop(*digests)

    def unit(self, name: str) -> Column:
        """Uniform in [0, 1)."""
        return F.col(f"_draw_{name}")

    def between(self, name: str, low: float, high: float) -> Column:
        """Uniform double in [low, high)."""
        return F.lit(float(low)) + self.unit(name) * F.lit(float(high - low))

    def integer(self, name: str, low: int, high: int) -> Column:
        """Uniform bigint in [low, high], both ends included."""
        return F.floor(self.unit(name) * F.lit(float(high - low + 1))) + F.lit(low)

    def cents(self, name: str, low: int, high: int) -> Column:
        """Amount between ``low`` and ``high`` cents, rounded to whole cents, in currency units."""
        whole = F.floor(self.unit(name) * F.lit(float(high - low)) + F.lit(low + 0.5))
        return whole.cast("double") / F.lit(100.0)

    def pick(self, name: str, values: list[str]) -> Column:
        """One of ``values``."""
        index = self.integer(name, 1, len(values)).cast("int")
        return F.element_at(F.array(*[F.lit(v) for v in values]), index)

    def chance(self, name: str, probability: float) -> Column:
        return self.unit(name) < F.lit(float(probability))
