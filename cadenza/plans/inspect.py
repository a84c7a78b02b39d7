"""Read a query's physical plan for the properties that matter at scale.

``plan_summary`` counts shuffles, broadcasts, joins by strategy and Python
evaluation nodes, and lists each Parquet scan's read schema and pushed
filters, from the executed plan (after AQE when the query already ran).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

_PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
_BAD_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@dataclass
class PlanSummary:
    exchanges: int = 0
    broadcasts: int = 0
    joins: dict[str, int] = field(default_factory=dict)
    python_nodes: int = 0
    bad_joins: list[str] = field(default_factory=list)
    scans: list[tuple[str, str, str]] = field(default_factory=list)  # (table, read schema, pushed filters)


def physical_plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plan_summary(df: DataFrame) -> PlanSummary:
    text = physical_plan_text(df)
    s = PlanSummary()
    for line in text.splitlines():
        node = line.strip().lstrip(":+- ").strip()
        if node.startswith("Exchange") or node.startswith("ShuffleQueryStage"):
            s.exchanges += 1
        if node.startswith("BroadcastExchange"):
            s.broadcasts += 1
        m = re.match(r"(\w+Join)\b", node)
        if m:
            s.joins[m.group(1)] = s.joins.get(m.group(1), 0) + 1
        if any(node.startswith(p) for p in _PYTHON_NODES):
            s.python_nodes += 1
        for bad in _BAD_JOINS:
            if node.startswith(bad):
                s.bad_joins.append(bad)
        if "FileScan parquet" in node:
            table = re.search(r"\[file:[^\]]*/([^/\]]+)\]", node)
            schema = re.search(r"ReadSchema: (struct<[^ ]*>)", node)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", node)
            s.scans.append(
                (table.group(1) if table else "?", schema.group(1) if schema else "?", pushed.group(1) if pushed else "[]")
            )
    return s
