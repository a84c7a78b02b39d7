"""Association between the popularity label and the features.

Correlations are one aggregate over all pairs (the reference runs one job per
feature). Quartile groups use exact linear quantile edges, closed on the
right (not ``ntile``, which splits ties, nor ``QuantileDiscretizer``, which
is approximate and closed on the left). Mutual information is re-aimed as a
binned estimate from joint bucket counts: a different estimator from the
reference's nearest-neighbour one, so its numbers differ by design.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.scalar import safe_ln
from cadenza.operators.quantiles import percentile_columns


def corr_with_label(df: DataFrame, label: str, features: Sequence[str], null_as_zero: bool = False) -> DataFrame:
    """(feature, correlation) — Pearson of the label with each feature.

    NULL pairs are skipped (``corr``); ``null_as_zero`` reproduces
    ``df.stat.corr``, which reads NULL as 0 (trap T4).
    """

    def v(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(0.0)) if null_as_zero else x

    row = df.agg(*[F.corr(v(label), v(f)).alias(f) for f in features])
    return row.unpivot(ids=[], values=list(features), variableColumnName="feature", valueColumnName="correlation")


def corr_matrix(df: DataFrame, columns: Sequence[str], log_label: str | None = None) -> DataFrame:
    """(left, right, correlation) for every ordered pair, one aggregate.

    With ``log_label`` that column is replaced by its natural log (NULL when
    not positive, trap T9) before correlating.
    """
    cols = {c: (safe_ln(c) if c == log_label else F.col(c).cast("double")) for c in columns}
    aggs = []
    for a in columns:
        for b in columns:
            aggs.append(F.corr(cols[a], cols[b]).alias(f"{a}\u0001{b}"))
    row = df.agg(*aggs)
    long = row.unpivot(ids=[], values=[f"{a}\u0001{b}" for a in columns for b in columns],
                       variableColumnName="pair", valueColumnName="correlation")
    parts = F.split(F.col("pair"), "\u0001")
    return long.select(parts[0].alias("left"), parts[1].alias("right"), "correlation")


def quartile_edges(df: DataFrame, col: str) -> DataFrame:
    """Exact linear 25/50/75 % of ``col`` as one row (e1, e2, e3)."""
    return percentile_columns(df, [col], {"e1": 0.25, "e2": 0.5, "e3": 0.75}).drop("feature")


def with_quartile(df: DataFrame, col: str, out: str = "quartile") -> DataFrame:
    """Q1..Q4 by exact edges, intervals closed on the right; ties share a group."""
    # One scalar subquery for all three edges (each subquery is a pass over df).
    edges = quartile_edges(df, col).select(F.struct("e1", "e2", "e3")).scalar()
    e1, e2, e3 = edges["e1"], edges["e2"], edges["e3"]
    x = F.col(col)
    q = (
        F.when(x.isNull(), F.lit(None))
        .when(x <= e1, "Q1")
        .when(x <= e2, "Q2")
        .when(x <= e3, "Q3")
        .otherwise("Q4")
    )
    return df.withColumn(out, q)


def quartile_groups(df: DataFrame, col: str, features: Sequence[str]) -> DataFrame:
    """D5 summary: per quartile group, size, label range and feature means."""
    g = with_quartile(df, col)
    return g.groupBy("quartile").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(col).alias(f"min_{col}"),
        F.max(col).alias(f"max_{col}"),
        *[F.avg(f).alias(f"mean_{f}") for f in features],
    )


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    width = hi - lo
    return F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((x - lo) / width * bins), F.lit(bins - 1))).cast("int")


def mutual_information_binned(
    df: DataFrame, label: str, features: Sequence[str], bins: int = 10, precision: int | None = 6
) -> DataFrame:
    """D8 re-aimed: (feature, mutual_information) in nats from equal-width bins.

    MI = sum p(x,y) ln(p(x,y) / (p(x) p(y))) over the joint bin counts of rows
    where both values are present. Work is one pass over the rows plus
    aggregates over at most bins x bins cells per feature. Values are rounded
    to ``precision`` digits before binning, so a value on a bin edge lands in
    the same bin whatever the summation order that produced it.
    """

    def val(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.round(x, precision) if precision is not None else x

    y = val(label)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), val(f).alias("x")) for f in features])
    long = df.select(y.alias("y"), F.explode(pairs).alias("kv")).select("kv.feature", "kv.x", "y").where(
        F.col("x").isNotNull() & F.col("y").isNotNull()
    )
    bounds = long.groupBy("feature").agg(
        F.min("x").alias("xlo"), F.max("x").alias("xhi"), F.min("y").alias("ylo"), F.max("y").alias("yhi")
    )
    # One row per feature: bounded by the number of features asked for.
    binned = long.join(F.broadcast(bounds), "feature").select(
        "feature",
        _bin(F.col("x"), F.col("xlo"), F.col("xhi"), bins).alias("bx"),
        _bin(F.col("y"), F.col("ylo"), F.col("yhi"), bins).alias("by"),
    )
    joint = binned.groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).cast("double").alias("nxy"))
    per_f = Window.partitionBy("feature")
    cells = joint.select(
        "feature",
        "nxy",
        F.sum("nxy").over(per_f).alias("n"),
        F.sum("nxy").over(Window.partitionBy("feature", "bx")).alias("nx"),
        F.sum("nxy").over(Window.partitionBy("feature", "by")).alias("ny"),
    )
    term = (F.col("nxy") / F.col("n")) * F.ln(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return cells.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


def scatter_points(
    df: DataFrame, key: str, x: str, label: str, sample_fraction: float | None = None, seed: int = 0
) -> DataFrame:
    """(key, x, log_label, quartile, mean_x) — the data behind a scatter with a mean line.

    Quartiles and the mean are always computed on all rows; ``sample_fraction``
    only thins the returned points (seeded), for plotting.
    """
    g = with_quartile(df, label)
    mean_x = df.select(F.avg(x)).scalar()
    out = g.select(key, F.col(x).cast("double").alias(x), safe_ln(label).alias("log_label"), "quartile",
                   mean_x.alias(f"mean_{x}"))
    return out.sample(fraction=sample_fraction, seed=seed) if sample_fraction is not None else out


def rename_nested_aggregates(df: DataFrame) -> DataFrame:
    """``avg(avg(x))`` -> ``x`` (innermost name inside the parentheses)."""
    import re

    names = [re.split(r"[()]", c) for c in df.columns]
    clean = [next((p for p in reversed(parts) if p), c) if "(" in c else c for parts, c in zip(names, df.columns)]
    return df.toDF(*clean)
