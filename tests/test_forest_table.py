"""The node table of a saved forest, followed and summed by DuckDB as well."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cadenza.operators import modeling as M
from cadenza.operators.forest_table import node_importances, predict, predict_first, saved_nodes
from cadenza.plans import q_modeling as Q
from cadenza.sources.sinks import save_model
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def forest(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("forest") / "model")
    train, test = M.hash_split(Q._prepared_for_fitting(spark, SF))
    pipeline, _ = M.forest_pipeline(Q.FEATURES, Q.LABEL, M.ForestSpec(num_trees=12, subsampling_rate=0.7, min_instances=5))
    save_model(pipeline.fit(train), path)
    model = PipelineModel.load(path)
    return saved_nodes(spark, path), model, model.transform(test)


@pytest.fixture(scope="module")
def con(forest):
    nodes, _, scored = forest
    db = duckdb.connect()
    db.register("nodes", nodes.toPandas().astype({"feature": "Int64", "left_node": "Int64", "right_node": "Int64"}))
    wide = scored.select("pid", *[vector_to_array("scaled_features")[i].alias(f"x{i}") for i in range(len(Q.FEATURES))])
    db.register("wide", wide.toPandas())
    db.execute("CREATE TABLE test_rows AS SELECT pid, " + "[" + ", ".join(f"x{i}" for i in range(len(Q.FEATURES))) + "] AS x FROM wide")
    return db


def test_predictions_follow_from_the_nodes(forest, con):
    nodes, _, scored = forest
    recursive = """
        WITH RECURSIVE walk AS (
            SELECT t.pid, t.x, n.tree, n.node FROM test_rows t, nodes n WHERE n.node = 0
            UNION ALL
            SELECT w.pid, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n.left_node ELSE n.right_node END
            FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE n.feature IS NOT NULL)
        SELECT pid, avg(value) AS prediction FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY pid"""
    for own in (scored.select("pid", "prediction"), predict(nodes, scored, "scaled_features", ["pid"], 5)):
        ok, msg = compare(own, con, recursive)
        assert ok, msg
    assert con.execute("SELECT count(*), count(DISTINCT tree), max(feature) FROM nodes").fetchone()[1] == 12


def test_first_trees_are_scored_without_a_row_per_tree(forest):
    nodes, model, scored = forest
    last = model.stages[-1]
    own = last.copy({last.leafCol: "leaf", last.predictionCol: "p"})
    fast = predict_first(own, nodes, scored, ["pid"], [3, 12])
    slow = predict(nodes, scored, "scaled_features", ["pid"], 5, [3, 12])
    plan = fast._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    pairs = fast.join(slow.toDF("pid", "s3", "s12"), "pid").collect()
    assert len(pairs) == scored.count() > 100
    assert all(abs(r.prediction_3 - r.s3) < 1e-9 and abs(r.prediction_12 - r.s12) < 1e-9 for r in pairs)


def test_importances_follow_from_the_nodes(spark, forest, con):
    nodes, model, _ = forest
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(Q.FEATURES))
    sql = f"""
        WITH g AS (SELECT tree, feature, sum(gain * n) AS g FROM nodes WHERE feature IS NOT NULL GROUP BY 1, 2),
        s AS (SELECT feature, sum(share) AS share FROM (SELECT feature, g / sum(g) OVER (PARTITION BY tree) AS share FROM g) x GROUP BY 1)
        SELECT name AS feature, coalesce(share, 0) / (SELECT sum(share) FROM s) AS importance FROM (VALUES {names}) v(place, name) LEFT JOIN s ON s.feature = place"""
    for own in (M.importances(spark, model, Q.FEATURES), node_importances(nodes, Q.FEATURES)):
        ok, msg = compare(own, con, sql)
        assert ok, msg


def test_nodes_are_trees(forest):
    nodes, _, _ = forest
    inner = nodes.where("feature IS NOT NULL")
    children = inner.select("tree", F.explode(F.array("left_node", "right_node")).alias("node"))
    assert children.join(nodes, ["tree", "node"]).count() == 2 * inner.count()
    assert nodes.where("feature IS NULL").count() == inner.count() + 12


@pytest.mark.parametrize("name", ["tree_predictions", "tree_importances"])
def test_a_tree_that_sql_grows_at_sf001(spark, name):
    sf = "/root/testdata/sf0.01"
    from cadenza.plans.catalog import load_all

    q = load_all()[name]
    ok, msg = compare(q.build(spark, sf), duck(sf), q.sql)
    assert ok, msg
