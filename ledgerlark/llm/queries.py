"""The registered queries: each operator over its whole table, with the parameters of production."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import fingerprints as prints
from ledgerlark.llm import (
    decontaminate,
    language,
    merkle,
    mixing,
    periodic,
    quality,
    secret_scan,
    similarity_join,
    substrings,
    token_files,
    toxicity,
    url_filter,
)
from ledgerlark.session import fresh_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = similarity_join.link(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return linked.select("doc_id", "n_shingles", "component_id")


def word_tokenizer() -> str:
    """The path of the public tokenizer of the contract, on the driver and on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    token_files.write(docs, path, word_tokenizer())
    return token_files.read(spark, path, with_ids=False)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prints.with_next(_table(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited", prints.edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_fp", prints.winnow(F.col("edited")))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        prints.digest(F.col("fp")).alias("fingerprint"),
        prints.digest(F.col("edited_fp")).alias("edited_fingerprint"),
        prints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        prints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find(docs, _table(spark, sf_dir, "benchmark"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = language.remainder(F.col("doc_id"), 3) == 1
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held)
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.remainder(F.col("doc_id"), 5) == 0
    said = language.identify(docs.select("doc_id", "text"), language.fit(docs.filter(~held)))
    return said.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.rate(docs, model).select("doc_id", "severity", "grade", "toxic")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = merkle.row_digest(F.regexp_replace("text", "\n", ""))
    other = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, tampered)
    rows = merkle.manifest(_table(spark, sf_dir, "documents"), other)
    folded = merkle.folded(F.coalesce("other", "leaf"), F.col("path"))
    proof = merkle.proof_digest(F.col("path")).alias("proof_sha256")
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof, folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic.replayed(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.find(docs, keep=["doc_id"])
    # The greatest is the longest; of equally long ones the first, of those the one with the least period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("_most", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_most.col2")).alias("start"),
        F.col("_most.length").alias("length"),
        (-F.col("_most.col3")).alias("period"),
        F.floor(1000 * F.col("_most.length") / -F.col("_most.col3")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find(docs, secret_scan.fit(docs), keep=["doc_id"])
    base = F.filter("spans", lambda s: s.kind != secret_scan.MODEL)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(kind) for kind in secret_scan.KINDS if kind != secret_scan.MODEL]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_ngram_join": op2_ngram_join,
    "op3_token_files": op3_token_files,
    "op4_fingerprints": op4_fingerprints,
    "op5_url_filter": op5_url_filter,
    "op6_decontaminate": op6_decontaminate,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_quality": op8_quality,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_secret_scan": op13_secret_scan,
}
