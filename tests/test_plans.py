"""Plan properties of every registered query (scale regressions)."""

from __future__ import annotations

import pytest

from cadenza.plans.catalog import load_all
from cadenza.plans.inspect import plan_summary

SF_DIR = "/root/testdata/sf0.001"
REGISTRY = load_all()
# Model fitting and the stream read their own materialised outputs; their
# final plans are not the interesting part.
SKIP = {"forest_cv_metrics", "forest_importances", "forest_predictions", "ablation"}
# Their readers scan the bytes of documents in tasks.
SCANS_BYTES = {"json_bad_documents", "json_large_document"}
WIDE_TABLES = {"lineitem.parquet": 11, "orders.parquet": 6, "part.parquet": 6, "documents.parquet": 5}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SKIP))
def test_plan_has_no_cartesian_join_or_python_eval(spark, name):
    df = REGISTRY[name].build(spark, SF_DIR)
    s = plan_summary(df)
    assert not s.bad_joins, f"{name}: {s.bad_joins}"
    assert s.python_nodes == 0 or name in SCANS_BYTES, f"{name}: Python evaluation in the plan"
    for table, schema, _ in s.scans:
        if table in WIDE_TABLES:
            read = schema.count(":")
            assert read < WIDE_TABLES[table], f"{name}: {table} read without column pruning ({schema})"
