"""Values that are computed once per row.

Spark pushes a filter on a computed column below the projection and then computes the column in
both places. It does not push filters through a generator, so a costly value that is filtered on
is generated, as the only element of an array.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def one(value: Column) -> Column:
    """The value itself; for ``select``."""
    return F.explode(F.array(value))


def one_row(struct: Column) -> Column:
    """The fields of a struct as columns, all NULL for a NULL struct; for ``select``."""
    return F.inline(F.array(struct))
