"""The registered queries on the smallest tables, with their SQL where there is one, and the pipeline against its rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codexlake.llm import registry

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_shingles component_id", "op2": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", "op3": "doc_id item_id", "op4": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5": "page_id host path rule verdict", "op6": "doc_id n_assign n_access n_hex base_sha256 spans", "op7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op8": "page_id url text n_chars",
    "op9": "doc_id held_out score predicted", "op10": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_contract_columns(spark, name):
    out = registry.QUERIES[name](spark, DATA)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert out.columns[: len(wanted)] == wanted
    rows = out.collect()
    if name.split("_")[0] in ("op1", "op6", "op7", "op9", "op10"):
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    frame = registry.QUERIES[name](spark, DATA)
    cursor = con.execute(registry.ORACLE_SQL[name])
    assert [c[0] for c in cursor.description] == frame.columns
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, frame.collect()), key=order) == sorted(cursor.fetchall(), key=order)


def test_pipeline_stages(spark):
    """Every stage on all that its predecessor kept; its decisions take effect; columns stay."""
    from codexlake.llm import ngram_jaccard, secret_scan

    extra = spark.createDataFrame([(900_001, None), (900_002, ""), (900_002, ""), (900_003, "a token=abcdefghijkl b"), (None, "no id here")], "doc_id long, text string")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(extra, allowMissingColumns=True).withColumn("t", F.lit("clash")).cache()
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA).cache()
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
            break
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        if name == "near_duplicates":
            groups = ngram_jaccard.near_duplicates(docs, 5, 4, 5)
            assert out.where("doc_id IS NOT NULL").count() == groups.where("doc_id IS NOT NULL").select("component_id").distinct().count()
        elif name == "decontamination":
            norm = lambda s: " ".join((s or "").lower().split())
            items = [norm(r.text) for r in bench.collect()]
            assert {r.doc_id for r in docs.collect() if r.doc_id is not None and any(t in norm(r.text) for t in items)}.isdisjoint({r.doc_id for r in out.collect()})
        elif name == "secrets":
            assert out.count() == docs.count() and all(not secret_scan.base_spans(r.text or "") for r in out.collect())
            assert [r.text for r in out.where("doc_id = 900003").collect()] == ["a <secret> b"]
        docs = out


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("FALSE")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0
