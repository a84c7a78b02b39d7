"""Exact percentiles that stay distributed when one group is huge.

``percentile`` (Spark's exact aggregate) keeps a value -> count map per group
and merges each group's map in one task: a popularity level that holds a third
of all collections then ends up, with all its distinct values, in one task.
The operator here computes the same numbers (linear interpolation between the
two closest ranks, as ``percentile`` and DuckDB's ``quantile_cont``) with
bounded work per task, on one path for all sizes:

1. (group, feature, value) -> count is written once (map-side combine; a hot
   group is spread by value over the shuffle). All later steps read that table;
2. one mergeable quantile sketch per feature gives splitters that cut its
   values into ``BUCKETS ** LEVELS`` ranges: one row per feature, of a size
   fixed by these two parameters, so it is broadcast;
3. counts per (group, feature, range) and their running sums, at most
   ``BUCKETS ** LEVELS`` rows a group, tell which ranges hold a wanted rank;
4. only the values of those ranges get running counts of their own, one range
   of one group per window partition: 1 / BUCKETS ** LEVELS of a feature's
   values is left to one task.

The splitters only balance the work; they never change the result. A range of
equal values can't be cut, but counts have one row per value, so it is one row.

NULLs don't count; NaN is a value above all others (as in ``percentile``). A
NULL group is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import materialize

#: Ranges one range is cut into, and how often: 1/4096 of a feature's values is left to one task.
BUCKETS = 64
LEVELS = 2


def _range_of(v: Column, splits: Column, before: Column, buckets: int, stride: int) -> Column:
    """Number of the range of ``v`` one level below range ``before``, as a binary search of nested CASEs.

    Every ``stride``-th splitter bounds a range of this level. Higher-order
    functions (``filter``) are evaluated without code generation; this
    expression compiles into the stage's generated code and costs
    log2(buckets) comparisons per row.
    """
    first = before * buckets

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(splits[(first + mid + 1) * stride - 1] < v, search(mid + 1, hi)).otherwise(search(lo, mid))

    return first + search(0, buckets - 1)


def _value_counts(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Written table (g, f, v, c): the group as a struct, the feature's number, a value or NULL, its rows."""
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(value_cols)])
    long = df.select(*group_cols, F.explode(pairs).alias("_kv")).select(*group_cols, "_kv.f", "_kv.v")
    counts = long.groupBy(*group_cols, "f", "v").agg(F.count(F.lit(1)).alias("c"))
    # A struct is never NULL itself and equal to one with NULLs at the same places.
    group = F.struct(*[F.col(c) for c in group_cols]) if group_cols else F.struct(F.lit(0).alias("_all"))
    return materialize(counts.select(group.alias("g"), "f", "v", "c"))


def _at_ranks(counts: DataFrame, probs: Sequence[float], buckets: int, levels: int) -> DataFrame:
    """(g, f, p, pos, v_lo, v_hi): the values at the ranks beside each wanted position, on one row or two.

    ``p`` is the place of the probability in ``probs``.
    """
    values = counts.where(F.col("v").isNotNull())
    ranges = buckets**levels
    # One literal: an array of as many literals as ranges would take seconds to analyse.
    grid = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    splitters = values.groupBy("f").agg(F.percentile_approx(F.when(~F.isnan("v"), F.col("v")), grid, 10 * ranges).alias("splits"))
    rows = values.join(F.broadcast(splitters), "f").withColumn("b", F.lit(0))
    for level in range(levels):
        rows = rows.withColumn("b", _range_of(F.col("v"), F.col("splits"), F.col("b"), buckets, buckets ** (levels - 1 - level)))
    rows = rows.select("g", "f", "b", "v", "c")

    def holds(first: Column, past: Column) -> list[tuple[Column, Column]]:
        pos = [(F.col("n") - 1) * float(p) for p in probs]
        inside = lambda r: (first <= r) & (r < past)
        return [(inside(F.floor(x)), inside(F.ceil(x))) for x in pos]

    any_of = lambda pairs: F.array_contains(F.array(*[x for pair in pairs for x in pair]), True)
    whole = Window.partitionBy("g", "f")
    sums = rows.groupBy("g", "f", "b").agg(F.sum("c").alias("c"))
    sums = sums.withColumns({"past": F.sum("c").over(whole.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)), "n": F.sum("c").over(whole)})
    before = F.col("past") - F.col("c")
    hit = sums.where(any_of(holds(before, F.col("past")))).select("g", "f", "b", before.alias("before"), "n")
    inside = rows.join(hit, ["g", "f", "b"])
    own = Window.partitionBy("g", "f", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("past", F.col("before") + F.sum("c").over(own))
    at = holds(F.col("past") - F.col("c"), F.col("past"))
    inside = inside.where(any_of(at))
    found = [
        F.when(lo | hi, F.struct(F.lit(i).alias("p"), ((F.col("n") - 1) * float(p)).alias("pos"), F.when(lo, F.col("v")).alias("v_lo"), F.when(hi, F.col("v")).alias("v_hi")))
        for i, (p, (lo, hi)) in enumerate(zip(probs, at))
    ]
    return inside.select("g", "f", F.explode(F.array_compact(F.array(*found))).alias("_r")).select("g", "f", "_r.*")


def _interpolated(when: Column | None = None) -> Column:
    """The value at the position, from the rows at its two ranks (those that fulfil ``when``)."""
    pick = lambda c: F.max(F.col(c) if when is None else F.when(when, F.col(c)))
    pos, lo, hi = pick("pos"), pick("v_lo"), pick("v_hi")
    return F.when(F.floor(pos) == F.ceil(pos), lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi)


def percentiles_long(
    df: DataFrame,
    group_cols: Sequence[str],
    value_cols: Sequence[str],
    probs: Sequence[float],
    buckets: int = BUCKETS,
    levels: int = LEVELS,
) -> DataFrame:
    """(group_cols..., feature, p, value): exact percentiles, long form.

    Groups whose feature is all NULL have no row for that feature. ``buckets``
    and ``levels`` only spread the work. The value counts are written when
    this is called.
    """
    rows = _at_ranks(_value_counts(df, group_cols, value_cols), probs, buckets, levels)
    names, wanted = (F.array(*map(F.lit, x)) for x in (value_cols, map(float, probs)))
    out = rows.groupBy("g", "f", "p").agg(_interpolated().alias("value"))
    groups = [F.col("g")[c].alias(c) for c in group_cols]
    return out.select(*groups, names[F.col("f")].alias("feature"), wanted[F.col("p")].alias("p"), "value")


def percentile_columns(df: DataFrame, value_cols: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """(feature, one column per name in ``probs``): exact percentiles of the whole columns; an all-NULL column has no row."""
    rows = _at_ranks(_value_counts(df, [], value_cols), list(probs.values()), BUCKETS, LEVELS)
    out = rows.groupBy("f").agg(*[_interpolated(F.col("p") == i).alias(name) for i, name in enumerate(probs)])
    return out.select(F.array(*map(F.lit, value_cols))[F.col("f")].alias("feature"), *probs)


def percentiles_wide(
    df: DataFrame,
    group_cols: Sequence[str],
    value_cols: Sequence[str],
    prob: float = 0.5,
    method: str = "distributed",
    buckets: int = BUCKETS,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per group, one column per value column: the ``prob`` percentile.

    ``method="distributed"`` works for groups of any size;
    ``"builtin"`` is one aggregate with Spark's ``percentile``, for groups
    that are records (a collection's items). Both give the same numbers.
    """
    group_cols = list(group_cols)
    if method == "builtin":
        aggs = [F.percentile(F.col(c).cast("double"), F.lit(prob)).alias(c) for c in value_cols]
        return df.groupBy(*group_cols).agg(*aggs)
    counts = _value_counts(df, group_cols, value_cols)
    found = _at_ranks(counts, [prob], buckets, levels).drop("p")
    # Groups without a value have a row as well.
    rows = found.unionByName(counts.select("g", F.lit(-1).alias("f")), allowMissingColumns=True)
    wide = rows.groupBy("g").agg(*[_interpolated(F.col("f") == i).cast("double").alias(f"_{i}") for i in range(len(value_cols))])
    return wide.select(*[F.col("g")[c].alias(c) for c in group_cols], *[F.col(f"_{i}").alias(c) for i, c in enumerate(value_cols)])
