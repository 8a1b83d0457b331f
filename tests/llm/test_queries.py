"""Registered queries: SQL where there is some, contracts elsewhere, and the pipeline."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from actuaria.llm.oracle import SQL
from actuaria.llm.queries import QUERIES
from actuaria.sources.tables import table_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import with_extras

COLUMNS = {
    "op1_topk_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_bpe_codec": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_simhash_groups": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_repeated_passages": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op9_private_data": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string",
    },
    "op10_decontamination": {
        "doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string",
        "contaminated": "boolean",
    },
    "op11_centroid_clusters": {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint",
        "centroid_sha256": "string",
    },
    "op12_merkle_manifest": {
        "doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
        "folded_root": "string", "verified": "boolean",
    },
    "op13_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{table_path(SF_SMALL, t)}')")
    found = QUERIES[name](spark, SF_SMALL)
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert found.columns == columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    assert dict(QUERIES[name](spark, SF_SMALL).dtypes) == COLUMNS[name]


def test_one_row_per_document(spark):
    n = spark.read.parquet(table_path(SF_SMALL, "documents")).count()
    for name in ("op6_line_templates", "op7_toxicity", "op9_private_data"):
        rows = QUERIES[name](spark, SF_SMALL).select("doc_id").collect()
        assert len(rows) == len({r[0] for r in rows}) == n, name


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(table_path(SF_SMALL, "documents"))
    docs = docs.unionByName(spark.createDataFrame([(10**6, None, "en", None, 0), (None, "a null id", "en", "s", 9)], docs.schema))
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        source, docs = docs, spark.read.parquet(str(tmp_path / name))
        after = docs.count()
        if i < 4:
            assert docs.columns == columns and 0.7 * before < after <= before, name
        before = after
    texts = {r["doc_id"]: r["text"] or "" for r in source.collect()}
    done = docs.collect()
    assert len(done) == len(texts)
    for r in done:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_pipeline_of_an_empty_table_with_extra_columns(spark):
    docs = with_extras(spark.read.parquet(table_path(SF_SMALL, "documents")).limit(0))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0, name


def test_pipeline_query_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    again = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and rows
