"""Roll item-level features up to the collection and the popularity level.

C1 item-feature roll-up (mean or exact median), C2 main-feature means,
C3 genre counts, C4 occurrences of a named value, C5 feature-table assembly.

All functions take the *flat* occurrence form (one row per collection item,
what ``explode`` of the nested array gives; see
``cadenza.operators.nested.explode_beside``), so the same operator serves
nested input and already-flat input. Joins are plain equi left joins: Spark
(with AQE) picks broadcast or sort-merge from runtime sizes and splits skewed
partitions of the big side; nothing is hinted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.quantiles import percentiles_wide


def join_item_features(
    occurrences: DataFrame,
    features: DataFrame,
    feature_cols: Sequence[str],
    item_col: str = "track_uri",
    key: str = "uri",
) -> DataFrame:
    """Occurrences LEFT JOIN features on the item uri (unmatched -> NULL)."""
    feats = features.select(F.col(key).alias(item_col), *feature_cols)
    return occurrences.join(feats, item_col, "left")


def _stat(name: str, stat: str):
    if stat == "mean":
        return F.avg(name).alias(name)
    raise ValueError(f"unknown stat {stat!r}")


def rollup_to_collection(
    joined: DataFrame,
    feature_cols: Sequence[str],
    stat: str = "mean",
    collection: str = "pid",
    label: str = "num_followers",
) -> DataFrame:
    """A7/A8 per collection: (pid, label, features...) with mean or exact median.

    The label is averaged (or its median taken) per collection as well, so it
    becomes a double (reference behaviour). A collection is one record, so its
    medians are one aggregate.
    """
    cols = [label, *feature_cols]
    if stat == "median":
        return percentiles_wide(joined, [collection], cols, 0.5, method="builtin")
    return joined.groupBy(collection).agg(*[_stat(c, stat) for c in cols])


def rollup_to_popularity(
    per_collection: DataFrame,
    feature_cols: Sequence[str],
    stat: str = "mean",
    label: str = "num_followers",
) -> DataFrame:
    """Second level: one row per distinct label value (mean of means, T6).

    A level may hold a third of all collections: its medians are distributed.
    """
    if stat == "median":
        return percentiles_wide(per_collection, [label], feature_cols, 0.5)
    return per_collection.groupBy(label).agg(*[_stat(c, stat) for c in feature_cols])


def item_feature_rollup(
    occurrences: DataFrame,
    features: DataFrame,
    feature_cols: Sequence[str],
    stat: str = "mean",
    level: str = "popularity",
    item_col: str = "track_uri",
    collection: str = "pid",
    label: str = "num_followers",
) -> DataFrame:
    """Occurrences -> left join features -> per collection -> per popularity."""
    joined = join_item_features(occurrences, features, feature_cols, item_col)
    per_collection = rollup_to_collection(joined, feature_cols, stat, collection, label)
    if level == "collection":
        return per_collection
    return rollup_to_popularity(per_collection, feature_cols, stat, label)


# The output column names of the main-feature means (C2), as the
# reference's aggregate files name them.
MAIN_FEATURE_OUTPUTS = (
    ("num_tracks", "mean_track_length"),
    ("num_artists", "mean_num_artists"),
    ("num_albums", "mean_num_albums"),
)


def main_features_by_popularity(
    collections: DataFrame,
    label: str = "num_followers",
    outputs: Sequence[tuple[str, str]] = MAIN_FEATURE_OUTPUTS,
) -> DataFrame:
    """Mean of the collection-level counts per popularity level."""
    return collections.groupBy(label).agg(*[F.avg(src).alias(dst) for src, dst in outputs])


def genre_count_per_collection(
    occurrences: DataFrame,
    creators: DataFrame,
    missing: str = "null",
    item_col: str = "artist_uri",
    collection: str = "pid",
    label: str = "num_followers",
) -> DataFrame:
    """C3 first level: (pid, genre_count, label) over occurrences LEFT JOIN creators.

    ``missing`` decides what an occurrence whose creator has no row counts as
    (trap T3): ``"null"`` ignores it (Spark 4 ``size(NULL)``), ``"minus_one"``
    counts -1 (Spark 3 default), ``"nonempty"`` keeps only creators with at
    least one genre (the reference's commented-out filter).
    """
    cre = creators.select(F.col("uri").alias(item_col), "genres")
    joined = occurrences.select(collection, item_col, label).join(cre, item_col, "left")
    if missing == "null":
        count = F.size("genres")
    elif missing == "minus_one":
        count = F.coalesce(F.size("genres"), F.lit(-1))
    elif missing == "nonempty":
        joined = joined.where(F.size("genres") > 0)
        count = F.size("genres")
    else:
        raise ValueError(f"unknown missing mode {missing!r}")
    return joined.groupBy(collection).agg(
        F.avg(count).alias("genre_count"), F.avg(F.col(label)).alias(label)
    )


def genre_count_by_popularity(per_collection: DataFrame, label: str = "num_followers") -> DataFrame:
    """C3 second level: mean genre count per popularity level."""
    return per_collection.groupBy(label).agg(F.avg("genre_count").alias("genre_count"))


def named_value_count_per_collection(
    occurrences: DataFrame,
    heads: DataFrame,
    value: str,
    field: str = "artist_name",
    collection: str = "pid",
    label: str = "num_followers",
) -> DataFrame:
    """X6 on the flat form: per collection, items whose ``field`` equals ``value``.

    ``heads`` (pid, label) supplies every collection, so collections without
    items count 0, as ``size(filter(array, x -> x = v))`` on an empty array.
    """
    hits = (
        occurrences.where(F.col(field) == F.lit(value))
        .groupBy(collection)
        .agg(F.count(F.lit(1)).alias("value_count"))
    )
    return heads.select(collection, label).join(hits, collection, "left").select(
        collection, label, F.coalesce("value_count", F.lit(0)).alias("value_count")
    )


def named_value_by_popularity(per_collection: DataFrame, label: str = "num_followers") -> DataFrame:
    """C4: average count of the named value per popularity level."""
    return per_collection.groupBy(label).agg(F.avg("value_count").alias("avg_value_count"))


def feature_table(audio: DataFrame, main: DataFrame, genres: DataFrame, collection: str = "pid") -> DataFrame:
    """Audio roll-up LEFT JOIN main features LEFT JOIN genre counts on pid.

    The label comes from the audio roll-up only (left side, so collections
    without items are absent, trap T2).
    """
    return audio.join(main, collection, "left").join(genres, collection, "left")


def feature_table_one_pass(
    occurrences: DataFrame,
    features: DataFrame,
    creators: DataFrame,
    feature_cols: Sequence[str],
    item_col: str = "track_uri",
    creator_col: str = "artist_uri",
    album_col: str = "album_name",
    collection: str = "pid",
    label: str = "num_followers",
) -> DataFrame:
    """C5 straight from the occurrences: one scan and one shuffle by collection.

    Means, counts and the genre count all group by the collection, so both
    lookups are joined first and one aggregate gives the row. Distinct
    creators and albums are sets of one collection, which is one record.
    """
    cre = creators.select(F.col("uri").alias(creator_col), "genres")
    rows = join_item_features(occurrences, features, feature_cols, item_col).join(cre, creator_col, "left")
    distinct = lambda c: F.size(F.collect_set(c)).cast("long")
    return rows.groupBy(collection).agg(
        F.avg(label).alias(label),
        *[F.avg(c).alias(c) for c in feature_cols],
        F.count(F.lit(1)).alias("num_tracks"),
        distinct(creator_col).alias("num_artists"),
        distinct(album_col).alias("num_albums"),
        F.avg(F.size("genres")).alias("genre_count"),
    )
