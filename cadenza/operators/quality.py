"""Data-quality checks (Q1-Q8), one scan per check family.

The reference runs one job per column and per check and prints warnings;
here each family is one aggregate over all requested columns, returned as a
long table (column, check, value, ratio) that always has a row (trap T5).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long(df: DataFrame, columns: Sequence[str], prefix: str, value_name: str) -> DataFrame:
    """Unpivot the one-row aggregate ``prefix<col>`` columns to (column, value_name)."""
    return df.unpivot(
        ids=["rows"], values=[f"{prefix}{c}" for c in columns], variableColumnName="column", valueColumnName=value_name
    ).withColumn("column", F.expr(f"substring(`column`, {len(prefix) + 1})"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q1/Q2/Q3: (column, null_count, has_nulls, null_ratio) in one pass."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns])
    out = _long(agg, columns, "n_", "null_count")
    return out.select(
        "column",
        "null_count",
        (F.col("null_count") > 0).alias("has_nulls"),
        F.try_divide(F.col("null_count"), F.col("rows")).alias("null_ratio"),
    )


def empty_array_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q4: (column, empty_count, empty_ratio); NULL arrays are not counted as empty."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.size(c) == 0).alias(f"e_{c}") for c in columns])
    out = _long(agg, columns, "e_", "empty_count")
    return out.select("column", "empty_count", F.try_divide(F.col("empty_count"), F.col("rows")).alias("empty_ratio"))


def duplicate_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q5/Q6: (column, duplicated_values, has_duplicates).

    ``duplicated_values`` is the number of distinct values (NULL included)
    that occur more than once. One scan: every row emits (column, digest of
    the value) pairs, counted per pair with map-side combine (a hot value is
    combined before the shuffle), then the pairs seen more than once are
    counted per column. The 16-byte digest keeps long texts out of the
    shuffle; NULL has none, so it stays apart.
    """
    digest = lambda c: F.unhex(F.md5(F.col(c).cast("string").cast("binary")))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), digest(c).alias("value")) for c in columns])
    counted = (
        df.select(F.explode(pairs).alias("_p"))
        .groupBy("_p.column", "_p.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(F.count_if(F.col("n") > 1).alias("duplicated_values"))
    )
    # Every requested column gets a row, even one with no value at all.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    out = names.join(counted, "column", "left").select(
        "column", F.coalesce("duplicated_values", F.lit(0)).alias("duplicated_values")
    )
    return out.withColumn("has_duplicates", F.col("duplicated_values") > 0)


def value_intervals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min_value, max_value) as doubles, all columns in one aggregate."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}")]
    agg = df.agg(*aggs)
    per_col = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"lo_{c}").alias("min_value"), F.col(f"hi_{c}").alias("max_value"))
          for c in columns]
    )
    return agg.select(F.explode(per_col).alias("_v")).select("_v.*")


def quality_report(
    table: str,
    df: DataFrame,
    null_cols: Sequence[str] = (),
    array_cols: Sequence[str] = (),
    dup_cols: Sequence[str] = (),
    range_cols: Sequence[str] = (),
) -> DataFrame:
    """Q8: (table, column, check, value, ratio) for every requested check.

    Null counts, empty arrays and min/max are plain aggregates: they share one
    pass over ``df``. Duplicates need a grouping per value: a second pass.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    checks = []  # (column, check, value column, has ratio)
    for c in null_cols:
        aggs.append(F.count_if(F.col(c).isNull()).cast("double").alias(f"_n_{c}"))
        checks.append((c, "nulls", f"_n_{c}", True))
    for c in array_cols:
        aggs.append(F.count_if(F.size(c) == 0).cast("double").alias(f"_e_{c}"))
        checks.append((c, "empty_arrays", f"_e_{c}", True))
    for c in range_cols:
        aggs += [F.min(c).cast("double").alias(f"_lo_{c}"), F.max(c).cast("double").alias(f"_hi_{c}")]
        checks += [(c, "min", f"_lo_{c}", False), (c, "max", f"_hi_{c}", False)]
    parts = []
    if checks:
        row = df.agg(*aggs)
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(check).alias("check"),
                    F.col(v).alias("value"),
                    (F.try_divide(F.col(v), F.col("_rows")) if ratio else F.lit(None).cast("double")).alias("ratio"),
                )
                for c, check, v, ratio in checks
            ]
        )
        parts.append(row.select(F.explode(cells).alias("_c")).select("_c.*"))
    if dup_cols:
        u = duplicate_value_counts(df, dup_cols)
        parts.append(u.select("column", F.lit("duplicated_values").alias("check"),
                              F.col("duplicated_values").cast("double").alias("value"),
                              F.lit(None).cast("double").alias("ratio")))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(table).alias("table"), "column", "check", "value", "ratio")
