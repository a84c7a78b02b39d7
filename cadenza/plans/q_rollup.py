"""Roll-up queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import rollup as R
from cadenza.operators.quantiles import percentiles_long
from cadenza.plans.catalog import register
from cadenza.plans.oracle import r, with_ctes
from cadenza.sources import standins as S

FEATURES = ["p_size", "p_retailprice"]
# Fixed value: the named creator counted by C4 (a parameter of the operator).
NAMED_CREATOR = "Supplier#000000001"


def _mean_collection(spark, d):
    return R.item_feature_rollup(
        S.item_occurrences(spark, d), S.item_features(spark, d), FEATURES, "mean", "collection"
    )


def _median_collection(spark, d):
    return R.item_feature_rollup(
        S.item_occurrences(spark, d), S.item_features(spark, d), FEATURES, "median", "collection"
    )


@register(
    "rollup_mean_collection",
    with_ctes(["mean_coll"], f"SELECT pid, {r('num_followers')} AS num_followers, {r('p_size')} AS p_size, "
              f"{r('p_retailprice')} AS p_retailprice FROM mean_coll"),
    "C1 J1 A7 P2 P3",
)
def rollup_mean_collection(spark, d):
    return _mean_collection(spark, d)


@register(
    "rollup_mean_popularity",
    with_ctes(["mean_coll"], f"SELECT num_followers, {r('avg(p_size)')} AS p_size, "
              f"{r('avg(p_retailprice)')} AS p_retailprice FROM mean_coll GROUP BY num_followers"),
    "C1 J1 A7 T6 T2",
)
def rollup_mean_popularity(spark, d):
    return R.rollup_to_popularity(_mean_collection(spark, d), FEATURES, "mean")


@register(
    "rollup_median_collection",
    with_ctes(["median_coll"], f"SELECT pid, {r('num_followers')} AS num_followers, {r('p_size')} AS p_size, "
              f"{r('p_retailprice')} AS p_retailprice FROM median_coll"),
    "C1 J1 A8",
)
def rollup_median_collection(spark, d):
    return _median_collection(spark, d)


@register(
    "rollup_median_popularity",
    with_ctes(["median_coll"], f"SELECT num_followers, {r('quantile_cont(p_size, 0.5)')} AS p_size, "
              f"{r('quantile_cont(p_retailprice, 0.5)')} AS p_retailprice FROM median_coll GROUP BY num_followers"),
    "C1 J1 A8",
)
def rollup_median_popularity(spark, d):
    return R.item_feature_rollup(
        S.item_occurrences(spark, d), S.item_features(spark, d), FEATURES, "median", "popularity"
    )


@register(
    "median_null_and_nan",
    f"""SELECT nullif(l_linenumber, 1) AS line, {r('quantile_cont(q, 0.25)')} AS low, {r('quantile_cont(q, 0.5)')} AS median
        FROM (SELECT l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'NaN'::DOUBLE ELSE CAST(l_quantity AS DOUBLE) END AS q
              FROM lineitem) t GROUP BY 1""",
    "A8",
)
def median_null_and_nan(spark, d):
    """Percentiles by a key that may be NULL, of values of which a third are NaN (above all others)."""
    li = S.table(spark, d, "lineitem")
    q = F.when(F.col("l_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double"))
    rows = li.select(F.nullif("l_linenumber", F.lit(1)).alias("line"), q.alias("q"))
    return percentiles_long(rows, ["line"], ["q"], [0.25, 0.5]).groupBy("line").pivot("p", [0.25, 0.5]).agg(F.first("value")).toDF(
        "line", "low", "median"
    )


@register(
    "main_features_popularity",
    with_ctes(["colls"], f"""SELECT num_followers, {r('avg(num_tracks)')} AS mean_track_length,
        {r('avg(num_artists)')} AS mean_num_artists, {r('avg(num_albums)')} AS mean_num_albums
        FROM colls GROUP BY num_followers"""),
    "C2 A7",
)
def main_features_popularity(spark, d):
    return R.main_features_by_popularity(S.collections(spark, d, description=False))


def _genre_sql(count_expr: str, where: str = "") -> str:
    return with_ctes(["occ", "creators"], f"""
        SELECT num_followers, {r('avg(genre_count)')} AS genre_count FROM (
          SELECT o.pid, avg({count_expr}) AS genre_count, avg(o.num_followers) AS num_followers
          FROM occ o LEFT JOIN creators c ON c.uri = o.artist_uri {where} GROUP BY o.pid) t
        GROUP BY num_followers""")


def _genre_popularity(spark, d, missing):
    per = R.genre_count_per_collection(S.item_occurrences(spark, d), S.creators(spark, d), missing)
    return R.genre_count_by_popularity(per)


@register("genre_count_popularity", _genre_sql("len(c.genres)"), "C3 J2 P9 X5")
def genre_count_popularity(spark, d):
    return _genre_popularity(spark, d, "null")


@register("genre_count_popularity_minus_one", _genre_sql("coalesce(len(c.genres), -1)"), "C3 J2 T3")
def genre_count_popularity_minus_one(spark, d):
    return _genre_popularity(spark, d, "minus_one")


@register("genre_count_popularity_nonempty", _genre_sql("len(c.genres)", "WHERE len(c.genres) > 0"), "C3 F7 T3")
def genre_count_popularity_nonempty(spark, d):
    return _genre_popularity(spark, d, "nonempty")


@register(
    "genre_count_collection",
    with_ctes(["genre_coll"], f"SELECT pid, {r('genre_count')} AS genre_count, {r('num_followers')} AS num_followers "
              "FROM genre_coll"),
    "C3 J2",
)
def genre_count_collection(spark, d):
    return R.genre_count_per_collection(S.item_occurrences(spark, d), S.creators(spark, d), "null")


@register(
    "named_value_popularity",
    with_ctes(["occn", "heads"], f"""
        SELECT num_followers, {r('avg(value_count)')} AS avg_value_count FROM (
          SELECT h.pid, h.num_followers, coalesce(x.value_count, 0) AS value_count
          FROM heads h LEFT JOIN (SELECT pid, count(*) AS value_count FROM occn
                                  WHERE artist_name = '{NAMED_CREATOR}' GROUP BY pid) x USING (pid)) t
        GROUP BY num_followers"""),
    "C4 X6 F10",
)
def named_value_popularity(spark, d):
    per = R.named_value_count_per_collection(
        S.item_occurrences(spark, d, with_names=True), S.collection_heads(spark, d), NAMED_CREATOR
    )
    return R.named_value_by_popularity(per)


@register(
    "feature_table",
    with_ctes(["ftable"], f"""SELECT pid, {r('num_followers')} AS num_followers, {r('p_size')} AS p_size,
        {r('p_retailprice')} AS p_retailprice, num_tracks, num_artists, num_albums,
        {r('genre_count')} AS genre_count FROM ftable"""),
    "C5 J3",
)
def feature_table(spark, d):
    return build_feature_table(spark, d)


def build_feature_table(spark, d):
    occurrences = S.item_occurrences(spark, d, with_album=True)
    return R.feature_table_one_pass(occurrences, S.item_features(spark, d), S.creators(spark, d), FEATURES)


@register(
    "feature_table_joined",
    with_ctes(["ftable"], f"""SELECT pid, {r('num_followers')} AS num_followers, {r('p_size')} AS p_size,
        {r('p_retailprice')} AS p_retailprice, num_tracks, num_artists, num_albums,
        {r('genre_count')} AS genre_count FROM ftable"""),
    "C5 J3",
)
def feature_table_joined(spark, d):
    """The same table from parts made apart, as the reference assembles it from its files."""
    audio = _mean_collection(spark, d)
    main = S.collections(spark, d, description=False).select("pid", "num_tracks", "num_artists", "num_albums")
    genres = R.genre_count_per_collection(S.item_occurrences(spark, d), S.creators(spark, d)).drop("num_followers")
    return R.feature_table(audio, main, genres)


@register(
    "popularity_means_renamed",
    with_ctes(["mean_coll"], f"SELECT num_followers, {r('avg(p_size)')} AS p_size, "
              f"{r('avg(p_retailprice)')} AS p_retailprice FROM mean_coll GROUP BY num_followers"),
    "P12 A7",
)
def popularity_means_renamed(spark, d):
    """The reference's notebooks read aggregates whose columns are named
    ``avg(x)``; the names are cleaned after each aggregation (P12)."""
    from cadenza.operators.association import rename_nested_aggregates

    joined = R.join_item_features(S.item_occurrences(spark, d), S.item_features(spark, d), FEATURES)
    per = rename_nested_aggregates(joined.groupBy("pid").agg(*[F.avg(c) for c in ["num_followers", *FEATURES]]))
    return rename_nested_aggregates(per.groupBy("num_followers").agg(*[F.avg(c) for c in FEATURES]))
