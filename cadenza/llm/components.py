"""Connected components of an edge table by alternating large-star and small-star steps.

Up to ``LOCAL_EDGES`` edges are one task's work. More are first contracted in
each task, that many at a time, to a star per component of the task's edges.
Then each step groups by one end and takes a minimum, which combines map-side, and
joins it back; no neighbour list is ever collected. Every round is written to
the shared folder, so a lost executor costs one round at most; a round's
table goes when the next one is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import ship
from cadenza.session import materialize, release

#: Edges that a task holds at once.
LOCAL_EDGES = 1 << 20


def local_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (u, v), sorted, and the smallest node of each one's component."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        # Both ends' labels hang on to the lower one, then every label is followed to its root.
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(further := label[label], label):
            label = further
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return nodes, nodes[label]


def _contract(batches: Iterator[pa.RecordBatch], self_edges: bool) -> Iterator[pa.RecordBatch]:
    """Stars (u, v) of the components of up to ``LOCAL_EDGES`` edges at a time, v the smallest node."""
    held, n = [], 0

    def star() -> pa.RecordBatch:
        node, low = local_components(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
        keep = slice(None) if self_edges else node != low
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(low[keep])], ["u", "v"])

    for batch in batches:
        for at in range(0, batch.num_rows, LOCAL_EDGES):
            own = batch.slice(at, LOCAL_EDGES)
            if n + own.num_rows > LOCAL_EDGES:
                yield star()
                held, n = [], 0
            held.append(tuple(own.column(i).to_numpy() for i in (0, 1)))
            n += own.num_rows
    if held:
        yield star()


def _with_minimum(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the smallest of u and its neighbours."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(low, "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge.

    Null ends and self-loops are ignored; repeated edges count once; an empty
    table gives an empty result. Ends are bigint. The result is a written table.
    """
    edges = edges.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v"))
    edges = edges.where("u <> v")
    ship(edges.sparkSession)
    if edges.count() <= LOCAL_EDGES:
        one = edges.coalesce(1).mapInArrow(lambda batches: _contract(batches, True), "u bigint, v bigint")
        return materialize(one.toDF("node", "component"))
    edges = materialize(edges.mapInArrow(lambda batches: _contract(batches, False), "u bigint, v bigint").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = _with_minimum(large)
        small = near.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges, spent = materialize(small.where("u <> v").distinct()), edges
        release(spent)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # Stars now: every edge leads from a node to the smallest of its component.
    out = materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
    release(edges)
    return out
