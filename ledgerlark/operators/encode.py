"""Feature selection and encoding."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerlark.schema import CATEGORICAL
from ledgerlark.session import stored

# Columns that are never numeric features.
NOT_FEATURES = {
    "is_fraud",
    "label",
    "transaction_id",
    "event_ts",
    "currency",
    "merchant",
    "location",
}


def numeric_features(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns in schema order, each once."""
    skip = NOT_FEATURES | set(exclude)
    return [
        f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in skip
    ]


def categorical_features(df: DataFrame) -> list[str]:
    return [c for c in CATEGORICAL if c in df.columns]


def _counted(df: DataFrame, column: str) -> DataFrame:
    values = df.select(F.col(column).cast("string").alias("value")).where("value is not null")
    return values.groupBy("value").count()


def category_table(df: DataFrame, column: str) -> DataFrame:
    """Every value of a column with its index ``idx`` by falling frequency, ties in alphabetical order.

    Values are counted before the shuffle, dealt out by range of (count, value) and kept; a value's
    index is the number of values in the ranges before its own and its rank in it. No task and no
    driver holds all values.
    """
    order = [F.desc("count"), F.col("value")]
    ranged = _counted(df, column).repartitionByRange(*order)
    kept = stored(ranged.withColumn("range", F.spark_partition_id()), "categories")
    sizes = kept.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    # One row per range, as many as the shuffle has tasks.
    before = F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("range", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    index = (F.col("before") + rank - 1).cast("double")
    return kept.join(F.broadcast(offsets), "range").select("value", index.alias("idx"), "count")


def indexed_by(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Adds ``<column>_idx`` from a category table; NULL and unseen values get the next index."""
    known = table.select(F.col("value").alias(column), F.col("idx").alias(f"{column}_idx"))
    unseen = table.agg(F.count(F.lit(1)).cast("double")).head()[0]
    found = df.join(known, column, "left")
    columns = [*df.columns, F.coalesce(f"{column}_idx", F.lit(unseen)).alias(f"{column}_idx")]
    return found.select(*columns)


def top_categories(df: DataFrame, column: str, limit: int) -> list[str]:
    """The ``limit`` most frequent values, ties in alphabetical order."""
    top = _counted(df, column).orderBy(F.desc("count"), "value").limit(limit)
    return [row["value"] for row in top.collect()]


def category_indexer(
    df: DataFrame, columns: list[str], max_categories: int | None = None
) -> PipelineModel:
    """Indexes categories by falling frequency into ``<column>_idx``; unseen and NULL values share the
    index after the last.

    Every value has an index of its own. A model of MLlib holds the values it knows, so they pass
    through the driver here; ``category_table`` indexes columns too wide for that. A caller may give
    ``max_categories`` instead: values beyond it then share the index of unseen ones.
    """
    if max_categories is None:
        outputs = [f"{c}_idx" for c in columns]
        unlimited = StringIndexer(inputCols=columns, outputCols=outputs, handleInvalid="keep")
        return PipelineModel([unlimited.fit(df)])
    # One stage per column: a stage for several would pad shorter label lists with nulls.
    return PipelineModel(
        [
            StringIndexerModel.from_labels(
                top_categories(df, c, max_categories), c, f"{c}_idx", handleInvalid="keep"
            )
            for c in columns
        ]
    )


def one_hot(columns: list[str]) -> OneHotEncoder:
    """``<column>_idx`` to ``<column>_ohe``; unseen values take the last slot."""
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns],
        outputCols=[f"{c}_ohe" for c in columns],
        handleInvalid="keep",
    )


#: Share of the ranks by which an approximate quantile may miss.
MEDIAN_ERROR = 1e-3


def exact_medians(df: DataFrame, columns: list[str]) -> list[float | None]:
    """The lower median of each column's numbers; None for a column that has none.

    Approximate quantiles close to the middle enclose the median; a pass counts the numbers below and up to
    them, and only the distinct values in between are counted and ordered. All columns share the passes.
    """
    if not columns:
        return []
    values = [F.col(c).cast("double") for c in columns]
    names = [f"v{i}" for i in range(len(columns))]
    numbers = df.select(*[F.when(~F.isnan(v), v).alias(name) for v, name in zip(values, names)])
    near = numbers.approxQuantile(names, [0.5 - 2 * MEDIAN_ERROR, 0.5 + 2 * MEDIAN_ERROR], MEDIAN_ERROR)
    sides = []
    for name, bounds in zip(names, near):
        low, high = bounds or (0.0, 0.0)
        sides += [F.count(name), F.count_if(F.col(name) < low), F.count_if(F.col(name) <= high)]
    counts = numbers.agg(*[c.alias(f"n{i}") for i, c in enumerate(sides)]).head()
    held = []
    for i, (name, bounds) in enumerate(zip(names, near)):
        n, below, upto = counts[3 * i : 3 * i + 3]
        if not n:
            continue
        value, middle = F.col(name), (n + 1) // 2
        # Of few numbers the quantiles can miss the median by a rank.
        if below >= middle:
            between, rank = value < bounds[0], middle
        elif upto < middle:
            between, rank = value > bounds[1], middle - upto
        else:
            between, rank = value.between(*bounds), middle - below
        held.append(F.when(between, F.struct(F.lit(i).alias("i"), value.alias("value"), F.lit(rank).alias("rank"))))
    if not held:
        return [None] * len(columns)
    counted = numbers.select(F.inline(F.array_compact(F.array(*held)))).groupBy("i", "rank", "value").count()
    placed = counted.withColumn("upto", F.sum("count").over(Window.partitionBy("i").orderBy("value")))
    found = dict(placed.where("upto >= rank").groupBy("i").agg(F.min("value")).collect())
    return [found.get(i) for i in range(len(columns))]


def exact_median(df: DataFrame, column: str) -> float | None:
    """The lower median of a column's numbers; None if it has none."""
    return exact_medians(df, [column])[0]


def imputer(df: DataFrame, columns: list[str], strategy: str = "median") -> ImputerModel:
    """Fills missing numbers into ``<column>_filled``; trees do not accept NaN.

    ``median`` is exact, ``mean`` the mean of the numbers. A column without any number is filled with 0.
    """
    if strategy == "median":
        found = exact_medians(df, columns)
    elif strategy == "mean":
        number = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
        found = list(df.agg(*[F.avg(number[c]) for c in columns]).head())
    else:
        raise ValueError(f"strategy is median or mean, not {strategy!r}")
    spark = df.sparkSession
    surrogates = spark.createDataFrame([tuple(0.0 if v is None else float(v) for v in found)], ", ".join(f"`{c}` double" for c in columns))
    # The mean of a single row is that row, so its values become the model's.
    outputs = [f"{c}_filled" for c in columns]
    return Imputer(inputCols=columns, outputCols=outputs, strategy="mean").fit(surrogates)


def assembler(columns: list[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="keep")
