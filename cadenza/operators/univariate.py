"""Univariate summaries: frequency tables, word counts, describe, date trends.

A1-A5, A12, A14, O1-O3, X1, X2, X8, W1, D4, D10, D12. Every aggregate is a
partial + final aggregation (hot keys are combined map-side); shares and
weights divide by a scalar subquery, not by a window over everything.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.scalar import epoch_to_date, tokens
from cadenza.operators.quantiles import percentile_columns
from cadenza.session import materialize


def frequency(df: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """A1: (key, count) — ``groupBy(key).count()``; order with ``top_k`` if needed."""
    col = F.col(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "key")
    return df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def top_k(freq: DataFrame, k: int, key: str, count: str = "count") -> DataFrame:
    """O1/O3: the ``k`` most frequent keys, ties broken by key; adds ``rank`` (1..k).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top k, so only k rows per task reach the final merge.
    """
    top = freq.orderBy(F.desc(count), F.asc(key)).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(count), F.asc(key))))


def merge_frequencies(parts: Sequence[DataFrame], key: str, count: str = "count") -> DataFrame:
    """Add partial frequency tables up per key."""
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.sum(count).alias(count))


def shares(freq: DataFrame, count: str = "count") -> DataFrame:
    """Each key's share of the total (``count / (SELECT sum(count))``)."""
    total = freq.select(F.sum(count)).scalar()
    return freq.withColumn("share", F.col(count) / total)


def word_counts(df: DataFrame, text_col: str, drop_empty: bool = False) -> DataFrame:
    """X1 + A1: tokens split on white space, counted. NULL text gives no token;
    leading/trailing blanks give '' tokens unless ``drop_empty`` (T7). Whole texts."""
    words = df.select(F.explode(tokens(text_col)).alias("word"))
    if drop_empty:
        words = words.where(F.col("word") != "")
    return frequency(words, "word")


def term_weights(freq: DataFrame, key: str = "word", count: str = "count") -> DataFrame:
    """weight = count / max(count) (the word-cloud scaling)."""
    top = freq.select(F.max(count)).scalar()
    return freq.withColumn("weight", F.col(count) / top)


def describe_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A3 typed: (column, count, mean, stddev, min, max), one aggregate for all columns.

    Spark's ``describe`` gives the same numbers as strings in a wide table
    (``describe_strings``); this long typed form is what results are compared on.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count__{c}"),
            F.avg(x).alias(f"mean__{c}"),
            F.stddev_samp(x).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    row = df.agg(*aggs)
    # One aggregate, then one row per column by exploding an array of structs
    # (a single pass over df; a union of selects could re-run the aggregate).
    per_col = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"count__{c}").alias("count"),
                F.col(f"mean__{c}").alias("mean"),
                F.col(f"stddev__{c}").alias("stddev"),
                F.col(f"min__{c}").alias("min"),
                F.col(f"max__{c}").alias("max"),
            )
            for c in columns
        ]
    )
    return row.select(F.explode(per_col).alias("_d")).select("_d.*")


def describe_strings(df: DataFrame, *columns: str) -> DataFrame:
    """A3 as the reference stores it: Spark's ``describe`` (string values, trap T8)."""
    return df.describe(*columns)


def describe_quartiles(df: DataFrame, columns: Sequence[str], with_count: bool = True) -> DataFrame:
    """Describe plus exact linear 25/50/75 % (pandas ``describe``). The columns are written once, for both."""
    rows = materialize(df.select(*columns))
    base = describe_long(rows, columns)
    wide = percentile_columns(rows, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).withColumnRenamed("feature", "column")
    out = base.join(wide, "column", "left")
    return out if with_count else out.drop("count")


def mean_std_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, stddev) for error-bar charts."""
    return describe_long(df, columns).select(F.col("column").alias("feature"), "mean", "stddev")


def date_trend(df: DataFrame, epoch_col: str, unit: str = "day") -> DataFrame:
    """X8 + A1/A14: (period, count) of epoch-second timestamps, by day, month or year."""
    day = epoch_to_date(epoch_col)
    if unit == "day":
        period = day
    elif unit in ("month", "year"):
        period = F.trunc(day, unit)
    else:
        raise ValueError(f"unknown unit {unit!r}")
    # O2: ordered by period (a range-partitioned sort of the small result).
    return df.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("count")).orderBy("period")


def composition_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: avg/max/min/sample stddev of each column, one row."""
    aggs = []
    for c in columns:
        aggs += [
            F.avg(c).alias(f"avg_{c}"),
            F.max(c).alias(f"max_{c}"),
            F.min(c).alias(f"min_{c}"),
            F.stddev(c).alias(f"stddev_{c}"),
        ]
    return df.agg(*aggs)


def count_distinct(df: DataFrame, col: str, name: str) -> DataFrame:
    """A4: number of distinct non-NULL values."""
    return df.agg(F.count_distinct(col).alias(name))


def count_distinct_per_key(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """A5: distinct values of ``col`` per ``key``."""
    return df.groupBy(key).agg(F.count_distinct(col).alias(name))
