"""The registered search and run matrix take the whole grid of the operator."""

from __future__ import annotations

import inspect

import pytest

from cadenza.operators import modeling as M
from cadenza.operators import search as S
from cadenza.plans import q_modeling as Q

GRID = {"num_trees": M.GRID_NUM_TREES, "subsampling": M.GRID_SUBSAMPLING, "min_instances": M.GRID_MIN_INSTANCES, "strategies": M.GRID_STRATEGIES, "folds": 3}


@pytest.fixture
def prepared(spark, monkeypatch):
    rows = spark.createDataFrame([(i, float(1 + i % 3)) for i in range(30)], "pid bigint, num_followers double")
    monkeypatch.setattr(Q, "_prepared_for_fitting", lambda *a: rows)
    monkeypatch.setattr(Q, "_feature_table", lambda *a: rows)


def test_the_search_takes_the_whole_grid(spark, prepared, monkeypatch):
    seen, signature = [], inspect.signature(S.search_results)

    def results(*args, **kwargs):
        own = signature.bind(*args, **kwargs)
        own.apply_defaults()
        seen.append({k: own.arguments[k] for k in GRID})
        return spark.createDataFrame([(0, 64, 0.5, 1, "all", 10, 1.0, 0.5)], S.RESULTS)

    monkeypatch.setattr(S, "search_results", results)
    assert Q.forest_cv_metrics(spark, "").count() == 1
    assert seen == [GRID] and 90 == 3 * 3 * 5 * 2


def test_the_tuned_runs_take_the_whole_grid(spark, prepared, monkeypatch):
    seen, signature = [], inspect.signature(S.run_matrix)

    def matrix(*args, **kwargs):
        own = signature.bind(*args, **kwargs)
        own.apply_defaults()
        seen.append({k: own.arguments[k] for k in ("runs", "spec", "folds", "grid")})
        return spark.range(1)

    monkeypatch.setattr(S, "run_matrix", matrix)
    assert Q.ablation(spark, "").count() == 1
    assert seen == [{"runs": (*S.DEFAULT_RUNS, *S.TUNED_RUNS), "spec": M.ForestSpec(), "folds": 3, "grid": {}}]
