"""Registered queries: Spark implementation + DuckDB oracle, side by side.

Every query reads the driver tables (through ``cadenza.sources.standins``)
in full; nothing is capped, sampled or sub-set for the check. Float outputs
are rounded to ``DIGITS`` on both sides (summation order differs).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every float/double column (top level) to ``digits``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # + 0.0 turns -0.0 into 0.0, so both engines print the same value.
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None, operators: str = ""):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, lambda spark, d: rounded(fn(spark, d)), sql, operators)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from cadenza.plans import (  # noqa: F401
        q_association,
        q_io,
        q_modeling,
        q_nested,
        q_quality,
        q_rollup,
        q_univariate,
    )

    return REGISTRY
