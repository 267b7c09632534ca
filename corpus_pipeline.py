"""From raw documents to token files in five stages, each of which works on all its predecessor kept.

Languages that are not recognised go, one document of each group of near copies stays, documents that hold
test items go, sources are mixed to their target weights (a document may then appear more than once), and
what is left is written as token ids and read back.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import decontaminate, language, mixing, similarity_join
from ledgerlark.llm.queries import token_rows
from ledgerlark.session import fresh_dir

#: Near copies: five-word shingles with a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80

#: The models and the alignment cannot be expressed in SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language identification rejects."""
    said = language.identify(docs, language.fit(docs))
    return said.filter(~F.col("rejected")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest doc_id, of several the one with the smallest hash.

    Texts without a word belong to no group and stay.
    """
    linked = similarity_join.link(docs, SHINGLE, PERCENT).filter(F.col("component").isNotNull())
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row0", "row1")
    first = linked.groupBy("component").agg(F.min(order).alias("first"))
    first = first.select("component", F.col("first.row0").alias("first0"), F.col("first.row1").alias("first1"))
    stays = (F.col("row0") == F.col("first0")) & (F.col("row1") == F.col("first1"))
    rows = linked.groupBy("component", "row0", "row1").agg(F.count(F.lit(1)).alias("times")).join(first, "component")
    # Rows that go, and those that stay but are there several times.
    marks = rows.select("row0", "row1", stays.alias("_stays"), "times").filter("not _stays or times > 1").drop("times")
    found = docs.select("*", *similarity_join.row_keys(F.col("doc_id"), F.col("text"))).join(marks, ["row0", "row1"], "left")
    once = found.filter("_stays").dropDuplicates(["row0", "row1"])
    return found.filter("_stays is null").unionByName(once).select(*docs.columns)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a test item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mixing.mix(docs).filter("repeats > 0")
    return mixed.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files, and what a reader finds there."""
    return token_rows(spark, docs)


STAGES = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark", drop_benchmark_copies),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
