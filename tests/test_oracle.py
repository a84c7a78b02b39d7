"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

from __future__ import annotations

import os

import pytest

from cadenza.plans.catalog import load_all
from tests.oracle_harness import compare, duck

SF_DIR = os.environ.get("CADENZA_TEST_SF", "/root/testdata/sf0.001")
REGISTRY = load_all()
WITH_SQL = sorted(n for n, q in REGISTRY.items() if q.sql is not None)
ROWS_ONLY = sorted(n for n, q in REGISTRY.items() if q.sql is None)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(REGISTRY[name].build(spark, SF_DIR), con, REGISTRY[name].sql)
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    assert REGISTRY[name].build(spark, SF_DIR).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
