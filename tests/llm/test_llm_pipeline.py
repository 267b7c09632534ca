"""The registered queries as a whole: their SQL, their columns, and the pipeline's decisions."""

import duckdb
import pytest
from contract_check import connect, differences

import __spark_entry__ as contract
import corpus_pipeline
from ledgerlark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id size source_size target taken",
    "op2": "doc_id n_shingles component_id",
    "op3": "doc_id start n_tokens ids_crc32",
    "op4": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5": "page_id host path rule verdict",
    "op6": "doc_id item_id score",
    "op7": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8": "doc_id held_out score predicted",
    "op9": "doc_id held_out lang_pred score",
    "op10": "doc_id severity toxic",
    "op11": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13": "doc_id n_assign n_access n_hex base_sha256 spans",
}


def test_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(QUERIES[name](spark, SF).columns)


@pytest.mark.parametrize("name", ["op1_mix_sources", "op11_merkle_manifest"])
def test_equals_sql(spark, name):
    assert differences(spark, connect(SF), name, SF) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert [s[1].__name__ for s in corpus_pipeline.STAGES] == [
        "identify_language", "drop_near_copies", "drop_benchmark_copies", "mix_sources", "write_tokens",
    ]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    odd = spark.createDataFrame(
        [(1, None, "en", "a", 0), (2, "12", "en", "a", 2), (3, "x " * 9, None, None, 18), (3, "x " * 9, None, None, 18)], docs.schema
    )
    said = corpus_pipeline.identify_language(spark, docs.union(odd.filter("doc_id < 3")).filter("doc_id < 50 or text is null or text = '12'"), SF)
    assert said.filter("text is null or text = '12'").count() == 0
    assert corpus_pipeline.drop_near_copies(spark, odd, SF).count() == 3
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, "other words stand here now"), (2, long + " end"), (None, long), (None, "alone in the world today"), (4, " ")]
    rows += [(None, "alone in the world today"), (5, ""), (5, "")]
    several = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], docs.schema)
    stay = corpus_pipeline.drop_near_copies(spark, several, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in stay) == sorted(
        [("1", long), ("1", rows[1][1]), ("None", rows[4][1]), ("4", " "), ("5", ""), ("5", "")]
    )
    one_each = corpus_pipeline.drop_near_copies(spark, docs, SF)
    texts = [t for _, t in table]
    assert one_each.select("doc_id").distinct().count() == one_each.count() <= len(set(texts))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert out and all(b.start == a.start + a.n_tokens for a, b in zip(out, out[1:]))
    assert [r.doc_id for r in out] == sorted(r.doc_id for r in out)
