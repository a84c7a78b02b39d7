"""A saved forest as a table of nodes.

A saved model keeps its trees as rows, so they are read, not walked on the
driver: ``saved_nodes`` gives one row per node, ``predict`` follows them for
all rows at once, and ``node_importances`` sums the gains. All of it can be repeated in
any SQL engine from the same table. ``predict_first`` scores many rows by the
leaf numbers that a fitted model gives, without a row per tree.

A forest has at most ``num_trees * 2 ** (max_depth + 1)`` nodes, a bound of
its parameters alone, so the node table is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def saved_nodes(spark: SparkSession, path: str, pipeline: bool = True) -> DataFrame:
    """(tree, node, feature, threshold, left_node, right_node, value, n, gain) of the forest saved at ``path``, alone or as a stage of a pipeline.

    ``feature`` is the place in the forest's input vector; a leaf has no
    feature, threshold, children or gain. ``n`` is the weight of a node's
    training rows. Rows whose feature is at most the threshold go left.
    """
    saved = spark.read.parquet(f"{path.rstrip('/')}/{'stages/*RandomForestRegressor*/' if pipeline else ''}data")
    node = lambda c: F.col(f"nodeData.{c}")
    inner = node("leftChild") >= 0
    of_split = lambda c: F.when(inner, c)
    return saved.select(
        F.col("treeID").alias("tree"),
        node("id").alias("node"),
        of_split(node("split.featureIndex")).alias("feature"),
        of_split(F.get(node("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        of_split(node("leftChild")).alias("left_node"),
        of_split(node("rightChild")).alias("right_node"),
        node("prediction").alias("value"),
        F.get(node("impurityStats"), F.lit(0)).alias("n"),
        of_split(node("gain")).alias("gain"),
    )


def predict(nodes: DataFrame, rows: DataFrame, inputs: str, keys: Sequence[str], max_depth: int, sizes: Sequence[int] | None = None) -> DataFrame:
    """(keys..., prediction): the mean over the trees of the leaf that each row ends in.

    ``inputs`` names the forest's input vector, or an array of doubles. With
    ``sizes`` there is a column ``prediction_<n>`` for each n, the mean over
    the first n trees. The trees, a row each with its nodes as an array, are
    broadcast; a level is a projection that looks the next node up. The trees
    of a row stay in its partition until their mean, which combines map-side.
    """
    x = F.col(inputs) if rows.schema[inputs].dataType.typeName() == "array" else vector_to_array(inputs)
    fields = F.struct("node", "feature", "threshold", "left_node", "right_node", "value")
    # Node numbers of a tree run from 0 without gaps, so a node is found by its place.
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(fields)).alias("_t"))
    numbers = trees.select(F.collect_list("tree")).scalar()
    at = rows.select(*keys, x.alias("_x"), F.explode(numbers).alias("tree")).join(F.broadcast(trees), "tree").withColumn("_n", F.lit(0))
    for _ in range(max_depth):
        here = at.withColumn("_at", F.get("_t", F.col("_n")))
        side = F.when(F.get("_x", F.col("_at.feature")) <= F.col("_at.threshold"), F.col("_at.left_node")).otherwise(F.col("_at.right_node"))
        at = here.select(*keys, "_x", "tree", "_t", F.when(F.col("_at.feature").isNull(), F.col("_n")).otherwise(side).alias("_n"))
    leaf = at.select(*keys, "tree", F.get("_t", F.col("_n"))["value"].alias("value"))
    means = [F.avg("value").alias("prediction")] if sizes is None else [F.avg(F.when(F.col("tree") < n, F.col("value"))).alias(f"prediction_{n}") for n in sizes]
    return leaf.groupBy(*keys).agg(*means)


def predict_first(model, nodes: DataFrame, rows: DataFrame, keys: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """(keys..., prediction_<n> for each n): the mean over the first n trees, as ``predict`` with ``sizes``.

    ``model`` is the fitted forest with a ``leafCol``: it numbers the leaf of each tree that a row ends in, from the
    left, which is the order of their nodes. A leaf's value is found by that number, so a row stays one row.
    """
    leaves = nodes.where(F.col("feature").isNull()).groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("node", "value"))).alias("v"))
    values = leaves.select(F.array_sort(F.collect_list(F.struct("tree", F.col("v.value").alias("v"))))["v"]).scalar()
    out = model.transform(rows).select(*keys, vector_to_array(model.getLeafCol()).alias("_leaf"), values.alias("_value"))
    out = out.select(*keys, F.zip_with("_value", "_leaf", lambda v, leaf: F.get(v, leaf.cast("int"))).alias("_found"))
    before, tree = F.lit(0.0), 0
    for n in sorted(sizes):
        more = F.aggregate(F.slice("_found", tree + 1, n - tree), F.lit(0.0), lambda a, v: a + v)
        out = out.withColumn(f"_sum_{n}", before + more)
        before, tree = F.col(f"_sum_{n}"), n
    return out.groupBy(*keys).agg(*[F.avg(F.col(f"_sum_{n}") / n).alias(f"prediction_{n}") for n in sizes])


def node_importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance): gain times rows of each split, to a sum of 1 in each tree, then over all trees."""
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "place int, feature string")
    own = nodes.where("feature IS NOT NULL").groupBy("tree", F.col("feature").alias("place")).agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    trees = own.groupBy("tree").agg(F.sum("g").alias("total")).where("total > 0")
    shares = own.join(trees, "tree").groupBy("place").agg(F.sum(F.col("g") / F.col("total")).alias("g"))
    whole = shares.select(F.sum("g")).scalar()
    return names.join(shares, "place", "left").select("feature", F.coalesce(F.col("g") / whole, F.lit(0.0)).alias("importance"))
