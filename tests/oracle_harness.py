"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, equal rows
after sorting (floats compared after rounding).
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.sources.standins import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, digits) + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x, digits) for x in v))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return (1, float(v))
    return (4, str(v))


def compare(spark_df, con, sql: str, digits: int = 5):
    """Return (ok, message)."""
    sp = spark_df.toPandas()
    dk = con.execute(sql).fetchdf()
    sc, dc = sorted(sp.columns), sorted(dk.columns)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sp) != len(dk):
        return False, f"row count differs: spark={len(sp)} duck={len(dk)}"
    rows_s = sorted((tuple(_norm(r[c], 3) for c in sc), tuple(_norm(r[c], 9) for c in sc)) for r in sp.to_dict("records"))
    rows_d = sorted((tuple(_norm(r[c], 3) for c in sc), tuple(_norm(r[c], 9) for c in sc)) for r in dk.to_dict("records"))
    for (_, a), (_, b) in zip(rows_s, rows_d):
        if not _close(a, b):
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(sp)} rows equal"


def _close(a, b) -> bool:
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-6)
    return a == b
