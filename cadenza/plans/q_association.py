"""Association queries on the feature table."""

from __future__ import annotations

from cadenza.operators import association as A
from cadenza.plans.catalog import register
from cadenza.plans.oracle import r, with_ctes
from cadenza.plans.q_rollup import build_feature_table as _build
from cadenza.session import materialize


def build_feature_table(spark, d):
    """The feature table written once as Parquet (as the reference stores it
    between stages), so each analysis reads files instead of re-running the
    roll-up for every scalar subquery."""
    return materialize(_build(spark, d))

LABEL = "num_followers"
FEATURES = ["p_size", "p_retailprice", "num_tracks", "num_artists", "num_albums", "genre_count"]
MATRIX = [LABEL, "p_size", "p_retailprice", "num_tracks", "genre_count"]
LN_LABEL = f"CASE WHEN {LABEL} > 0 THEN ln({LABEL}) END"


def _corr_sql(zero: bool) -> str:
    def v(c):
        return f"coalesce(CAST({c} AS DOUBLE), 0.0)" if zero else f"CAST({c} AS DOUBLE)"

    return with_ctes(["ftable"], " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {r(f'corr({v(LABEL)}, {v(f)})')} AS correlation FROM ftable" for f in FEATURES))


@register("corr_label_features", _corr_sql(False), "D6 T4")
def corr_label_features(spark, d):
    return A.corr_with_label(build_feature_table(spark, d), LABEL, FEATURES)


@register("corr_label_features_null_as_zero", _corr_sql(True), "D6 T4")
def corr_label_features_null_as_zero(spark, d):
    return A.corr_with_label(build_feature_table(spark, d), LABEL, FEATURES, null_as_zero=True)


def _matrix_sql(log: bool) -> str:
    def v(c):
        return LN_LABEL if (log and c == LABEL) else f"CAST({c} AS DOUBLE)"

    return with_ctes(["ftable"], " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {r(f'corr({v(a)}, {v(b)})')} AS correlation FROM ftable"
        for a in MATRIX for b in MATRIX))


@register("corr_matrix", _matrix_sql(False), "D7")
def corr_matrix(spark, d):
    return A.corr_matrix(build_feature_table(spark, d), MATRIX)


@register("corr_matrix_log", _matrix_sql(True), "D7 X9 T9")
def corr_matrix_log(spark, d):
    return A.corr_matrix(build_feature_table(spark, d), MATRIX, log_label=LABEL)


_QUARTILE_CASE = f"""CASE WHEN {LABEL} IS NULL THEN NULL WHEN {LABEL} <= e.e1 THEN 'Q1' WHEN {LABEL} <= e.e2 THEN 'Q2'
    WHEN {LABEL} <= e.e3 THEN 'Q3' ELSE 'Q4' END"""
_EDGES = f"""(SELECT quantile_cont({LABEL}, 0.25) AS e1, quantile_cont({LABEL}, 0.5) AS e2,
    quantile_cont({LABEL}, 0.75) AS e3 FROM ftable) e"""


@register(
    "quartile_groups",
    with_ctes(["ftable"], f"""SELECT quartile, count(*) AS n, {r(f'min({LABEL})')} AS min_{LABEL},
        {r(f'max({LABEL})')} AS max_{LABEL}, {r('avg(p_size)')} AS mean_p_size, {r('avg(num_tracks)')} AS mean_num_tracks
        FROM (SELECT f.*, {_QUARTILE_CASE} AS quartile FROM ftable f, {_EDGES}) t GROUP BY quartile"""),
    "D5 T16",
)
def quartile_groups(spark, d):
    return A.quartile_groups(build_feature_table(spark, d), LABEL, ["p_size", "num_tracks"])


def _mi_sql(bins: int = 10) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(CAST({f} AS DOUBLE), 6) AS x, round(CAST({LABEL} AS DOUBLE), 6) AS y FROM ftable "
        f"WHERE {f} IS NOT NULL AND {LABEL} IS NOT NULL" for f in FEATURES)

    def b(v, lo, hi):
        return f"CASE WHEN {hi} - {lo} = 0 THEN 0 ELSE CAST(least(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}), {bins - 1}) AS INTEGER) END"

    return with_ctes(["ftable"], f"""SELECT feature, {r('sum((nxy / n) * ln(nxy * n / (nx * ny)))')} AS mutual_information
        FROM (SELECT feature, nxy, sum(nxy) OVER (PARTITION BY feature) AS n,
                     sum(nxy) OVER (PARTITION BY feature, bx) AS nx, sum(nxy) OVER (PARTITION BY feature, byy) AS ny
              FROM (SELECT l.feature, {b('l.x', 'b.xlo', 'b.xhi')} AS bx, {b('l.y', 'b.ylo', 'b.yhi')} AS byy,
                           CAST(count(*) AS DOUBLE) AS nxy
                    FROM ({long}) l JOIN (SELECT feature, min(x) AS xlo, max(x) AS xhi, min(y) AS ylo, max(y) AS yhi
                                          FROM ({long}) t GROUP BY feature) b USING (feature)
                    GROUP BY 1, 2, 3) j) c
        GROUP BY feature""")


@register("mutual_information_binned", _mi_sql(), "D8")
def mutual_information_binned(spark, d):
    return A.mutual_information_binned(build_feature_table(spark, d), LABEL, FEATURES, bins=10)


@register(
    "scatter_points",
    with_ctes(["ftable"], f"""SELECT pid, {r("CAST(p_size AS DOUBLE)")} AS p_size, {r(LN_LABEL)} AS log_label,
        {_QUARTILE_CASE} AS quartile, {r('(SELECT avg(p_size) FROM ftable)')} AS mean_p_size
        FROM ftable, {_EDGES}"""),
    "D9 X9 D5",
)
def scatter_points(spark, d):
    return A.scatter_points(build_feature_table(spark, d), "pid", "p_size", LABEL)
