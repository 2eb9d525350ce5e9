"""The registered text queries against their SQL, and the pipeline's contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from chainfold.llm import queries as Q
from chainfold.plans.check import compare, duckdb_views
from tests.conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SMOKE_DIR)


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(Q.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_query_matches_sql(spark, con, key):
    ok, report = compare(Q.QUERIES[key](spark, SMOKE_DIR), con, Q.ORACLE[key])
    assert ok, f"{key}: {report}"


@pytest.mark.parametrize("key", sorted(set(Q.QUERIES) - set(Q.ORACLE)))
def test_query_returns_every_row(spark, key):
    table, key_col = ("pages", "page_id") if key.startswith("op2_") else ("documents", "doc_id")
    ids = sorted(r[0] for r in spark.read.parquet(f"{SMOKE_DIR}/{table}.parquet").select(key_col).collect())
    assert sorted(r[key_col] for r in Q.QUERIES[key](spark, SMOKE_DIR).collect()) == ids


def test_pipeline_stages(spark):
    assert [n for n, _ in C.STAGES] == ["quality rules", "n-gram join", "personal data", "mixing", "byte-level BPE"]
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, empty, SMOKE_DIR).collect() == []
        assert stage(spark, empty, SMOKE_DIR).columns == docs.columns
    out = C.run(spark, SMOKE_DIR).collect()
    assert out and all(r["round_trip"] for r in out)
    ids = {r["doc_id"] for r in out}
    kept = {r["doc_id"] for r in Q.QUERIES["op7_quality_divergence"](spark, SMOKE_DIR).collect() if r["kept"]}
    assert ids <= kept
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMOKE_DIR}/labels.parquet").collect()}
    first = {r["component_id"] for r in E.queries()["op1_ngram_jaccard_join"](spark, SMOKE_DIR).collect()}
    clean = {i for i in kept & first if i in labels and labels[i]["quality"] == 1 and labels[i]["toxic"] == 0}
    assert len(clean - ids) <= 0.15 * len(clean)
