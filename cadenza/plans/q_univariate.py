"""Univariate and distribution queries (A1-A5, A12-A14, O1-O3, X1, X2, X8,
X10, W1, D1-D4, D10-D12)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cadenza.functions.scalar import log1p, text_length
from cadenza.operators import distribution as D
from cadenza.operators import univariate as U
from cadenza.plans.catalog import register
from cadenza.plans.oracle import r, with_ctes
from cadenza.sources import standins as S

SPLIT = r"'\s+'"


def _words_sql(source: str, col: str) -> str:
    return f"""SELECT word, count(*) AS count FROM (
        SELECT unnest(string_split_regex({col}, {SPLIT})) AS word FROM {source} WHERE {col} IS NOT NULL) t
        GROUP BY word"""


@register(
    "frequency_table",
    with_ctes(["creators"], "SELECT genre, count(*) AS count FROM (SELECT unnest(genres) AS genre FROM creators) t "
              "GROUP BY genre"),
    "A1 O1",
)
def frequency_table(spark, d):
    genres = S.creators(spark, d).select(F.explode("genres").alias("genre"))
    return U.frequency(genres, "genre")


@register(
    "frequency_top20",
    with_ctes(["occ"], """SELECT track_uri, count, CAST(row_number() OVER (ORDER BY count DESC, track_uri) AS INTEGER) AS rank
        FROM (SELECT track_uri, count(*) AS count FROM occ GROUP BY track_uri) t
        ORDER BY count DESC, track_uri LIMIT 20"""),
    "O3 A1 O1",
)
def frequency_top20(spark, d):
    freq = U.frequency(S.item_occurrences(spark, d, with_label=False), "track_uri")
    return U.top_k(freq, 20, "track_uri")


@register(
    "merge_frequencies",
    with_ctes(["colls"], f"""SELECT word, CAST(sum(count) AS BIGINT) AS count FROM (
        {_words_sql('colls', 'name')} UNION ALL {_words_sql('part', 'p_name')}) t GROUP BY word"""),
    "A12 U2",
)
def merge_frequencies(spark, d):
    a = U.word_counts(S.collections(spark, d, counts=False, description=False), "name")
    b = U.word_counts(S.table(spark, d, "part"), "p_name")
    return U.merge_frequencies([a, b], "word")


@register(
    "category_share",
    with_ctes(["colls"], f"""SELECT collaborative, count, {r('count / sum(count) OVER ()')} AS share
        FROM (SELECT collaborative, count(*) AS count FROM colls GROUP BY collaborative) t"""),
    "W1 A1 F9",
)
def category_share(spark, d):
    return U.shares(U.frequency(S.collections(spark, d, counts=False, description=False), "collaborative"))


@register(
    "term_weights",
    f"""SELECT word, count, {r('count / max(count) OVER ()')} AS weight FROM ({_words_sql('part', 'p_name')}) t""",
    "D12 X1 A1",
)
def term_weights(spark, d):
    return U.term_weights(U.word_counts(S.table(spark, d, "part"), "p_name"))


@register("name_word_count", with_ctes(["colls"], _words_sql("colls", "name")), "X1 A1 O1 T7")
def name_word_count(spark, d):
    return U.word_counts(S.collections(spark, d, counts=False, description=False), "name")


@register("description_word_count", with_ctes(["colls"], _words_sql("colls", "description")), "X1 A1")
def description_word_count(spark, d):
    return U.word_counts(S.collections(spark, d, counts=False), "description")


def _describe_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg(CAST({c} AS DOUBLE))')} AS mean,
                   {r(f'stddev_samp(CAST({c} AS DOUBLE))')} AS stddev, CAST(min({c}) AS DOUBLE) AS min,
                   CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c in cols
    )


@register(
    "name_length_stats",
    with_ctes(["colls"], _describe_sql("(SELECT length(name) AS name_length FROM colls) t", ["name_length"])),
    "X2 A3",
)
def name_length_stats(spark, d):
    lengths = S.collections(spark, d, counts=False, description=False).select(text_length("name").alias("name_length"))
    return U.describe_long(lengths, ["name_length"])


@register(
    "modification_trend_day",
    with_ctes(["colls"], """SELECT CAST(CAST(epoch_ms(modified_at * 1000) AS DATE) AS VARCHAR) AS period,
        count(*) AS count FROM colls GROUP BY 1"""),
    "X8 X13 A1 O2 T17",
)
def modification_trend_day(spark, d):
    return _iso(U.date_trend(S.collections(spark, d, counts=False, description=False), "modified_at", "day"))


def _iso(trend):
    # Dates leave as ISO text so every client reads the same value.
    return trend.withColumn("period", F.col("period").cast("string"))


@register(
    "modification_trend_month",
    with_ctes(["colls"], """SELECT CAST(CAST(date_trunc('month', CAST(epoch_ms(modified_at * 1000) AS DATE)) AS DATE)
        AS VARCHAR) AS period, count(*) AS count FROM colls GROUP BY 1"""),
    "A14 X8",
)
def modification_trend_month(spark, d):
    return _iso(U.date_trend(S.collections(spark, d, counts=False, description=False), "modified_at", "month"))


COMPOSITION = ["num_artists", "num_albums", "num_tracks"]


@register(
    "composition_stats",
    with_ctes(["colls"], "SELECT " + ", ".join(
        f"{r(f'avg({c})')} AS avg_{c}, max({c}) AS max_{c}, min({c}) AS min_{c}, {r(f'stddev_samp({c})')} AS stddev_{c}"
        for c in COMPOSITION) + " FROM colls"),
    "A2",
)
def composition_stats(spark, d):
    return U.composition_stats(S.collections(spark, d, description=False), COMPOSITION)


ITEM_FEATURES = ["p_size", "p_retailprice"]


@register("describe_long", with_ctes(["feats"], _describe_sql("feats", ITEM_FEATURES)), "A3 T8")
def describe_long(spark, d):
    return U.describe_long(S.item_features(spark, d), ITEM_FEATURES)


QUARTILE_COLS = ["num_tracks", "num_artists", "num_albums", "num_followers", "duration_ms"]


@register(
    "describe_quartiles",
    with_ctes(["colls"], " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg(CAST({c} AS DOUBLE))')} AS mean,
               {r(f'stddev_samp(CAST({c} AS DOUBLE))')} AS stddev, CAST(min({c}) AS DOUBLE) AS min,
               CAST(max({c}) AS DOUBLE) AS max, {r(f'quantile_cont({c}, 0.25)')} AS p25,
               {r(f'quantile_cont({c}, 0.5)')} AS p50, {r(f'quantile_cont({c}, 0.75)')} AS p75 FROM colls"""
        for c in QUARTILE_COLS)),
    "D4",
)
def describe_quartiles(spark, d):
    return U.describe_quartiles(S.collections(spark, d, description=False), QUARTILE_COLS)


@register(
    "mean_std_by_feature",
    with_ctes(["feats"], " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS stddev FROM feats"
        for c in ITEM_FEATURES)),
    "D10 F9",
)
def mean_std_by_feature(spark, d):
    return U.mean_std_long(S.item_features(spark, d), ITEM_FEATURES)


@register(
    "genre_count_distinct",
    with_ctes(["creators"], "SELECT count(DISTINCT genre) AS distinct_genres FROM (SELECT unnest(genres) AS genre "
              "FROM creators) t"),
    "A4",
)
def genre_count_distinct(spark, d):
    genres = S.creators(spark, d).select(F.explode("genres").alias("genre"))
    return U.count_distinct(genres, "genre", "distinct_genres")


@register(
    "genres_per_artist",
    with_ctes(["creators"], "SELECT id, count(DISTINCT genre) AS num_genres FROM (SELECT id, unnest(genres) AS genre "
              "FROM creators) t GROUP BY id"),
    "A5",
)
def genres_per_artist(spark, d):
    genres = S.creators(spark, d).select("id", F.explode("genres").alias("genre"))
    return U.count_distinct_per_key(genres, "id", "genre", "num_genres")


@register(
    "genre_count_stats",
    with_ctes(["creators"], _describe_sql("(SELECT len(genres) AS num_genres FROM creators) t", ["num_genres"])),
    "X5 A3",
)
def genre_count_stats(spark, d):
    sizes = S.creators(spark, d).select(F.size("genres").alias("num_genres"))
    return U.describe_long(sizes, ["num_genres"])


def _hist_sql(values_sql: str, n: int) -> str:
    return f"""WITH v AS ({values_sql}),
        b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
        c AS (SELECT CASE WHEN b.hi - b.lo = 0 THEN 0
                          ELSE CAST(least(floor((v.x - b.lo) / (b.hi - b.lo) * {n}), {n - 1}) AS INTEGER) END AS bin,
                     count(*) AS count
              FROM v, b GROUP BY 1)
        SELECT g.bin, {r(f'b.lo + g.bin * (b.hi - b.lo) / {n}')} AS lo, {r(f'b.lo + (g.bin + 1) * (b.hi - b.lo) / {n}')} AS hi,
               coalesce(c.count, 0) AS count
        FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({n})) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin"""


def _colls_cte_sql() -> str:
    from cadenza.plans.oracle import CTES, _resolve

    return ", ".join(f"{n} AS ({CTES[n][1]})" for n in _resolve(["colls"]))


@register(
    "histogram_equal_width",
    "WITH " + _colls_cte_sql() + ", " + _hist_sql(
        "SELECT CAST(num_tracks AS DOUBLE) AS x FROM colls WHERE num_tracks IS NOT NULL", 50)[5:],
    "D1",
)
def histogram_equal_width(spark, d):
    return D.equal_width_histogram(S.collections(spark, d, description=False), "num_tracks", 50)


@register(
    "histogram_log1p",
    "WITH " + _colls_cte_sql() + ", " + _hist_sql(
        "SELECT ln(1 + CAST(num_followers AS DOUBLE)) AS x FROM colls WHERE num_followers IS NOT NULL", 30)[5:],
    "D1 X10",
)
def histogram_log1p(spark, d):
    colls = S.collections(spark, d, description=False)
    return D.equal_width_histogram(colls, log1p(F.col("num_followers").cast("double")), 30)


@register(
    "histogram_integer",
    with_ctes(["creators"], """SELECT b.bin, count(x) AS count
        FROM (SELECT CAST(unnest(range(0, greatest((SELECT max(len(genres)) FROM creators), 1))) AS BIGINT) AS bin) b
             LEFT JOIN (SELECT least(CAST(len(genres) AS BIGINT), greatest(m - 1, 0)) AS x
                        FROM creators, (SELECT max(len(genres)) AS m FROM creators) mm) t ON t.x = b.bin
        GROUP BY b.bin"""),
    "D2",
)
def histogram_integer(spark, d):
    sizes = S.creators(spark, d).select(F.size("genres").alias("num_genres"))
    return D.integer_histogram(sizes, "num_genres")


@register(
    "boxplot_summary",
    with_ctes(["feats"], " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r('q1')} AS q1, {r('med')} AS median, {r('q3')} AS q3, {r('q3 - q1')} AS iqr,
               CAST(min({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS lower_whisker,
               CAST(max({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS upper_whisker,
               count(*) FILTER (WHERE NOT ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
            FROM feats, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
                                quantile_cont({c}, 0.75) AS q3 FROM feats) q
            WHERE {c} IS NOT NULL GROUP BY q1, med, q3"""
        for c in ITEM_FEATURES)),
    "D3",
)
def boxplot_summary(spark, d):
    return D.boxplot_summary(S.item_features(spark, d), ITEM_FEATURES)


@register(
    "kernel_density",
    with_ctes(["colls"], f"""SELECT CAST(g.point AS INTEGER) AS point, {r('s.lo + g.point * ((s.hi - s.lo) / 49)')} AS x,
            {r('sum(d.c * exp(-0.5 * ((s.lo + g.point * ((s.hi - s.lo) / 49) - d.x) / s.h) * ((s.lo + g.point * ((s.hi - s.lo) / 49) - d.x) / s.h))) / (s.n * s.h * ' + repr(math.sqrt(2 * math.pi)) + ')')} AS density
        FROM (SELECT count(x) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) * pow(CAST(count(x) AS DOUBLE), -0.2) AS h
              FROM (SELECT CAST(num_tracks AS DOUBLE) AS x FROM colls) v) s,
             (SELECT CAST(num_tracks AS DOUBLE) AS x, count(*) AS c FROM colls WHERE num_tracks IS NOT NULL GROUP BY 1) d,
             (SELECT range AS point FROM range(50)) g
        GROUP BY g.point, s.lo, s.hi, s.n, s.h"""),
    "D11",
)
def kernel_density(spark, d):
    return D.kernel_density(S.collections(spark, d, description=False), "num_tracks", 50)


@register(
    "describe_strings_pick",
    with_ctes(["feats"], " UNION ALL ".join(
        f"SELECT '{stat}' AS summary, {r(f'{fn}(p_size)')} AS p_size, {r(f'{fn}(p_retailprice)')} AS p_retailprice "
        "FROM feats" for stat, fn in [("mean", "avg"), ("stddev", "stddev_samp")])),
    "A3 F9 T8",
)
def describe_strings_pick(spark, d):
    """Spark's ``describe`` (string values, as the reference stores it), then
    the rows a chart needs picked by label (F9) and read back as numbers."""
    desc = U.describe_strings(S.item_features(spark, d), *ITEM_FEATURES)
    picked = desc.where(F.col("summary").isin("mean", "stddev"))
    return picked.select("summary", *[F.col(c).cast("double").alias(c) for c in ITEM_FEATURES])
