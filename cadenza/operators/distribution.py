"""Distribution shapes: histograms, box plots, kernel density.

The reference draws these with NumPy/matplotlib on one machine; here each is
an aggregate over the whole column. Bounds (min, max, quartiles) are scalar
subqueries, so one plan computes them and the bins together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.quantiles import percentile_columns


def _bins(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` bin numbers as a DataFrame (so empty bins are reported too)."""
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))


def equal_width_histogram(df: DataFrame, col: str | Column, n: int) -> DataFrame:
    """(bin, lo, hi, count), ``n`` equal bins from min to max.

    Bins are closed on the left, the last one also on the right (NumPy rule);
    when min = max every value is in bin 0. NULLs are not counted.
    """
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    bounds = vals.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = hi - lo
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / width * n), F.lit(n - 1))
    ).cast("int")
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = _bins(df, n).select(
        "bin",
        (lo + F.col("bin") * width / n).alias("lo"),
        (lo + (F.col("bin") + 1) * width / n).alias("hi"),
    )
    return edges.join(counts, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


#: Bins that one range of the integer histogram has.
CHUNK_BINS = 100_000


def integer_histogram(df: DataFrame, col: str) -> DataFrame:
    """All unit bins of 0..max, empty ones too; the maximum falls into the last bin [max-1, max].

    Values below 0 keep their own bins before those. The bins are made in two
    steps: ranges of ``CHUNK_BINS`` bins, dealt over the cores, then inside its
    range each counted bin is followed by the empty ones up to the next. So
    only counts and one row per range are shuffled, and no row or task holds
    the list of all bins, however large the maximum.
    """
    x = F.col(col).cast("long")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    top = vals.select(F.max("x")).scalar()
    last = F.greatest(top - 1, F.lit(0))
    counts = vals.groupBy(F.least(F.col("x"), last).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    range_of = lambda b: F.floor(b / CHUNK_BINS)
    starts = vals.agg(F.max("x").alias("top")).where("top is not null").select(
        F.explode(F.sequence(F.lit(0).cast("long"), range_of(F.greatest(F.col("top") - 1, F.lit(0))))).alias("range")
    ).select((F.col("range") * CHUNK_BINS).alias("bin"), F.lit(0).cast("long").alias("count"))
    rows = counts.unionByName(starts).withColumn("range", range_of(F.col("bin")))
    # A fixed number of partitions: the rows are few, but each range becomes many.
    rows = rows.repartition(df.sparkSession.sparkContext.defaultParallelism, "range").groupBy("range", "bin").agg(F.sum("count").alias("count"))
    end = F.least((F.col("range") + 1) * CHUNK_BINS, last + 1)
    after = F.coalesce(F.lead("bin").over(Window.partitionBy("range").orderBy("bin")), end)
    after = F.when(F.col("bin") < 0, F.col("bin") + 1).otherwise(after)
    bins = rows.withColumn("after", after).select("bin", "count", F.explode(F.sequence(F.col("bin"), F.col("after") - 1)).alias("b"))
    return bins.select(F.col("b").alias("bin"), F.when(F.col("b") == F.col("bin"), F.col("count")).otherwise(0).alias("count"))


def boxplot_summary(df: DataFrame, columns: list[str], whisker: float = 1.5) -> DataFrame:
    """D3: (feature, q1, median, q3, iqr, lower_whisker, upper_whisker, outliers).

    Quartiles by linear interpolation (exact); whiskers at the most extreme
    values inside the 1.5 IQR fences; outliers counted outside them.
    """
    quart = percentile_columns(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.explode(pairs).alias("kv")).select("kv.feature", "kv.v").where(F.col("v").isNotNull())
    # One row per feature: bounded by the number of columns asked for.
    fenced = long.join(F.broadcast(quart), "feature")
    iqr = F.col("q3") - F.col("q1")
    low_fence = F.col("q1") - whisker * iqr
    high_fence = F.col("q3") + whisker * iqr
    inside = (F.col("v") >= low_fence) & (F.col("v") <= high_fence)
    stats = fenced.groupBy("feature", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
    )
    return stats.select("feature", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                        "lower_whisker", "upper_whisker", "outliers")


def kernel_density(df: DataFrame, col: str, grid_points: int = 50) -> DataFrame:
    """Gaussian kernel density on ``grid_points`` points from min to max.

    Bandwidth by Scott's rule (sample stddev * n^(-1/5)). One aggregate with a
    sum per grid point: every task sends one row, whatever the values.
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    stats = vals.select(
        F.struct(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"),
                 F.max("x").alias("hi"))
    ).scalar()
    n, sd, lo, hi = stats["n"], stats["sd"], stats["lo"], stats["hi"]
    h = sd * F.pow(n.cast("double"), F.lit(-0.2))
    step = (hi - lo) / (grid_points - 1)
    # The four scalars become columns once; the sums below name columns only.
    rows = vals.select("x", lo.alias("lo"), step.alias("step"), h.alias("h"), n.alias("n"))
    z = lambda i: (F.col("lo") + i * F.col("step") - F.col("x")) / F.col("h")
    sums = rows.agg(
        F.first("lo").alias("lo"), F.first("step").alias("step"), F.first("h").alias("h"), F.first("n").alias("n"),
        F.array(*[F.sum(F.exp(-0.5 * z(i) * z(i))) for i in range(grid_points)]).alias("k"),
    ).where("n > 0")
    points = sums.select("lo", "step", "h", "n", F.posexplode("k").alias("point", "k"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return points.select("point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"), (F.col("k") / norm).alias("density"))
