"""Distributed running index (W2 rank curves, C7 id batches).

A global 0-based position in sort order, without a one-partition window and
without writing the rows: only the order keys are written. Range boundaries
are chosen once from a sample of the written keys, so the range of a row
follows from its keys alone, in every pass. Rows are counted per range; a
row's position is its place inside its range plus the rows of the ranges
before. A range has about ``RANGE_ROWS`` rows (more where that would be over
``MOST_RANGES`` ranges), and only one row per range and ``KEYS_PER_RANGE``
sampled keys of it pass through a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import materialize

#: Rows of a range, about, until there are ``MOST_RANGES``, and sampled keys per range.
RANGE_ROWS = 1 << 18
MOST_RANGES = 1 << 12
KEYS_PER_RANGE = 16


def _with_range(df: DataFrame, keys: str, bounds: Column) -> DataFrame:
    """``df`` with ``_range``: how many of the ascending bounds (at most ``MOST_RANGES`` - 1) are below or at the keys.

    Two binary searches as nested CASEs, among every 64th bound and among the 64 after it; a bound that isn't there is above all keys.
    """

    def search(place, lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.get(bounds, place(mid)) <= F.col(keys), search(place, mid + 1, hi)).otherwise(search(place, lo, mid))

    df = df.withColumn("_coarse", search(lambda i: F.lit(64 * i + 63), 0, MOST_RANGES // 64 - 1))
    fine = search(lambda i: F.col("_coarse") * 64 + i, 0, 63)
    return df.withColumn("_range", F.col("_coarse") * 64 + fine).drop("_coarse")


def with_row_index(df: DataFrame, order: Sequence[str | Column], index_col: str = "idx", range_rows: int | None = None) -> DataFrame:
    """``df`` plus ``index_col`` = position in the ascending ``order`` (NULLs first).

    Pass a unique last key for a repeatable result: rows of equal keys stay in
    one range, and their places among one another are left to the sort.
    """
    range_rows = range_rows or RANGE_ROWS
    cols = list(df.columns)
    # A struct of the keys compares field by field, with NULLs first, as the sort does.
    key = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)])
    keys = materialize(df.select(key.alias("k")))
    total = keys.count()
    ranges = min(-(-total // range_rows), MOST_RANGES)
    rows = df.withColumn("_key", key)
    if ranges > 1:
        # Boundaries balance the ranges only; the sample is of a fixed size per range.
        sampled = keys.sample(min(1.0, ranges * KEYS_PER_RANGE / total), 7).distinct().orderBy("k")
        sampled = sampled.groupBy().agg(F.array_sort(F.collect_list("k")).alias("s"))
        step = F.size("s") / ranges
        places = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("s", F.least(F.floor(i * step), F.size("s") - 1).cast("int")))
        bounds = materialize(sampled.select(places.alias("b")))
        one = bounds.select("b").scalar()
    else:  # at most range_rows rows: one window
        place = F.row_number().over(Window.orderBy("_key"))
        return rows.withColumn("_place", place).select(*cols, (F.col("_place").cast("long") - 1).alias(index_col))
    sizes = _with_range(keys, "k", one).groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))
    own = Window.partitionBy("_range").orderBy("_key")
    placed = _with_range(rows, "_key", one).withColumn("_place", F.row_number().over(own))
    return placed.join(F.broadcast(offsets), "_range").select(*cols, (F.col("_before") + F.col("_place") - 1).alias(index_col))
