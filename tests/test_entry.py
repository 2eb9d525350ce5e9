"""Driver contract: entry() smoke run, and every query against its oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from chainfold.plans import registry
from chainfold.plans.check import compare, duckdb_views
from tests.conftest import SMOKE_DIR

registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


def test_entry_smoke(spark):
    df = E.entry(spark)
    got = df.collect()
    assert df.columns == ["vertical", "highest_transaction_volume"]
    assert 0 < len(got) <= 5


def test_every_query_has_an_oracle():
    assert len(QUERIES) >= 85
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SMOKE_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, report = compare(QUERIES[key](spark, SMOKE_DIR), con, ORACLE[key])
    assert ok, f"{key}: {report}"
