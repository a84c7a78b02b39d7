"""Data-quality queries."""

from __future__ import annotations

from cadenza.operators import quality as Q
from cadenza.plans.catalog import register
from cadenza.plans.oracle import r, with_ctes
from cadenza.sources import standins as S

NULL_COLS = ["name", "description", "collaborative", "num_followers"]
DUP_COLS = ["pid", "name", "description"]
RANGE_COLS = ["num_tracks", "num_artists", "num_albums", "num_followers", "duration_ms", "modified_at"]


def _nulls_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS null_count,
                   count(*) FILTER (WHERE {c} IS NULL) > 0 AS has_nulls,
                   {r(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS null_ratio FROM {table}"""
        for c in cols
    )


def _dups_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE n > 1) AS duplicated_values,
                   count(*) FILTER (WHERE n > 1) > 0 AS has_duplicates
            FROM (SELECT {c}, count(*) AS n FROM {table} GROUP BY {c}) t"""
        for c in cols
    )


def _ranges_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value
            FROM {table}"""
        for c in cols
    )


@register("quality_nulls", with_ctes(["colls"], _nulls_sql("colls", NULL_COLS)), "Q1 Q2 Q3 F1 A11 T5 T15")
def quality_nulls(spark, d):
    return Q.null_counts(S.collections(spark, d), NULL_COLS)


@register(
    "quality_empty_arrays",
    with_ctes(["creators"], f"""SELECT 'genres' AS "column", count(*) FILTER (WHERE len(genres) = 0) AS empty_count,
        {r('count(*) FILTER (WHERE len(genres) = 0) / count(*)')} AS empty_ratio FROM creators"""),
    "Q4 F2 A11",
)
def quality_empty_arrays(spark, d):
    return Q.empty_array_counts(S.creators(spark, d), ["genres"])


@register("quality_duplicates", with_ctes(["colls"], _dups_sql("colls", DUP_COLS)), "Q5 Q6 F3")
def quality_duplicates(spark, d):
    return Q.duplicate_value_counts(S.collections(spark, d), DUP_COLS)


@register("quality_intervals", with_ctes(["colls"], _ranges_sql("colls", RANGE_COLS)), "Q7 A6")
def quality_intervals(spark, d):
    return Q.value_intervals(S.collections(spark, d), RANGE_COLS)


def _report_sql() -> str:
    nulls = " UNION ALL ".join(
        f"""SELECT 'collections' AS "table", '{c}' AS "column", 'nulls' AS "check",
                   CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value,
                   {r(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS ratio FROM colls"""
        for c in NULL_COLS
    )
    dups = " UNION ALL ".join(
        f"""SELECT 'collections', '{c}', 'duplicated_values', CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE), NULL
            FROM (SELECT {c}, count(*) AS n FROM colls GROUP BY {c}) t"""
        for c in DUP_COLS
    )
    ranges = " UNION ALL ".join(
        f"""SELECT 'collections', '{c}', 'min', CAST(min({c}) AS DOUBLE), NULL FROM colls
            UNION ALL SELECT 'collections', '{c}', 'max', CAST(max({c}) AS DOUBLE), NULL FROM colls"""
        for c in RANGE_COLS
    )
    cre = f"""SELECT 'creators', 'genres', 'empty_arrays', CAST(count(*) FILTER (WHERE len(genres) = 0) AS DOUBLE),
                 {r('count(*) FILTER (WHERE len(genres) = 0) / count(*)')} FROM creators
              UNION ALL SELECT 'creators', c, 'nulls', CAST(n AS DOUBLE), {r('n / rows')} FROM (
                SELECT 'id' AS c, count(*) FILTER (WHERE id IS NULL) AS n, count(*) AS rows FROM creators
                UNION ALL SELECT 'name', count(*) FILTER (WHERE name IS NULL), count(*) FROM creators
                UNION ALL SELECT 'uri', count(*) FILTER (WHERE uri IS NULL), count(*) FROM creators) t
              UNION ALL SELECT 'creators', 'id', 'duplicated_values', CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE), NULL
                FROM (SELECT id, count(*) AS n FROM creators GROUP BY id) t"""
    return with_ctes(["colls", "creators"], f"{nulls} UNION ALL {dups} UNION ALL {ranges} UNION ALL {cre}")


@register("quality_report", _report_sql(), "Q8")
def quality_report(spark, d):
    colls = Q.quality_report(
        "collections", S.collections(spark, d), null_cols=NULL_COLS, dup_cols=DUP_COLS, range_cols=RANGE_COLS
    )
    cre = Q.quality_report(
        "creators", S.creators(spark, d), null_cols=["id", "name", "uri"], array_cols=["genres"], dup_cols=["id"]
    )
    return colls.unionByName(cre)
