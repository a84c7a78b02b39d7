"""End-to-end jobs over real inputs: the reference's stages, on user paths.

Inputs are the nested collection dump (one JSON document per file), item
features and creator records (JSON lines). Each flow reads with explicit
schemas, composes the library's operators and writes its outputs under
``out_dir`` (overwrite). Nothing is collected to the driver except model
reports (bounded by the grid size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.functions.scalar import text_length
from cadenza.operators import association as A
from cadenza.operators import modeling as M
from cadenza.operators import nested as N
from cadenza.operators import quality as Q
from cadenza.operators import rollup as R
from cadenza.operators import univariate as U
from cadenza.session import materialize
from cadenza.sources import readers as RD
from cadenza.sources import sinks as SK

# The item-feature columns rolled up per collection, in the
# reference's order, and the label.
AUDIO_FEATURES = [
    "acousticness", "danceability", "duration_ms", "energy", "instrumentalness", "key",
    "liveness", "loudness", "mode", "speechiness", "tempo", "valence",
]
MODEL_FEATURES = AUDIO_FEATURES + ["num_tracks", "num_artists", "num_albums", "genre_count"]
LABEL = "num_followers"


def load_collections(spark: SparkSession, dump_path: str) -> DataFrame:
    """S1 + P1: the dump's collections, one row each."""
    return N.explode_records(RD.read_nested_json(spark, dump_path, schemas.DUMP, multi_line=True))


def load_items(spark: SparkSession, path: str) -> DataFrame:
    """Item features, exact duplicates removed."""
    return RD.read_json_lines(spark, path, schemas.ITEM_FEATURES, distinct=True)


def load_creators(spark: SparkSession, path: str) -> DataFrame:
    """Creator records, exact duplicates removed."""
    return RD.read_json_lines(spark, path, schemas.CREATORS, distinct=True)


def occurrences(collections: DataFrame) -> DataFrame:
    """(pid, num_followers, item fields...) — inner explode of the items."""
    return N.explode_beside(collections, "tracks", ["pid", LABEL])


def clean(spark: SparkSession, dump_path: str, items_path: str, creators_path: str, out_dir: str) -> None:
    """Cleaned creators, item features (3 link columns dropped) and collections as Parquet."""
    SK.write_parquet(load_creators(spark, creators_path), f"{out_dir}/creators")
    items = N.drop_columns(load_items(spark, items_path), ["analysis_url", "track_href", "type"])
    SK.write_parquet(items, f"{out_dir}/item_features")
    SK.write_parquet(N.clean_collections(load_collections(spark, dump_path)), f"{out_dir}/collections")


def quality(spark: SparkSession, dump_path: str, items_path: str, creators_path: str) -> DataFrame:
    """Q8 over the three inputs: nulls, empty genre arrays, duplicates, value ranges.

    Each input is parsed once, into Parquet.
    """
    colls = materialize(load_collections(spark, dump_path).drop("tracks"))
    items = materialize(load_items(spark, items_path))
    creators = materialize(load_creators(spark, creators_path))
    parts = [
        Q.quality_report("creators", creators, null_cols=["id", "name", "uri"], array_cols=["genres"],
                         dup_cols=["id", "name", "uri"]),
        Q.quality_report("item_features", items, null_cols=["uri", "track_href", "analysis_url"],
                         dup_cols=["uri", "track_href", "analysis_url"],
                         range_cols=[c for c in AUDIO_FEATURES] + ["time_signature"]),
        Q.quality_report("collections", colls, null_cols=["description", "name"], dup_cols=["name"],
                         range_cols=["num_albums", "num_artists", "num_edits", "num_followers", "num_tracks"]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def univariate(spark: SparkSession, dump_path: str, items_path: str, creators_path: str, out_dir: str) -> None:
    """The univariate analyses of collections, creators and item features, as CSV.

    Each input is parsed once, into Parquet; every output reads its columns of that.
    """
    colls = materialize(load_collections(spark, dump_path).drop("tracks"))
    creators = materialize(load_creators(spark, creators_path))
    items = materialize(load_items(spark, items_path))
    out = {
        "collections/composition": U.composition_stats(colls, ["num_artists", "num_albums", "num_tracks"]),
        "collections/duration": U.describe_strings(colls, "duration_ms"),
        "collections/name_words": U.word_counts(colls, "name").orderBy(F.desc("count"), "word"),
        "collections/name_length": U.describe_strings(colls.select(text_length("name").alias("name_length")),
                                                      "name_length"),
        "collections/modification_trend": U.date_trend(colls, "modified_at", "day"),
        "collections/followers": U.describe_strings(colls, "num_followers"),
        "collections/description_words": U.word_counts(colls, "description").orderBy(F.desc("count"), "word"),
        "collections/edits": U.describe_strings(colls, "num_edits"),
        "collections/collaborative": U.frequency(colls, "collaborative"),
        "creators/genre_counts": U.frequency(creators.select(F.explode("genres").alias("genre")), "genre")
        .orderBy(F.desc("count"), "genre"),
        "creators/genre_stats": U.describe_strings(creators.select(F.size("genres").alias("num_genres")),
                                                   "num_genres"),
        "creators/unique_genres": U.count_distinct(creators.select(F.explode("genres").alias("genre")), "genre",
                                                   "distinct_genres"),
        "creators/genres_per_creator": U.count_distinct_per_key(
            creators.select("id", F.explode("genres").alias("genre")), "id", "genre", "num_genres"),
        "items/summary": U.describe_strings(items.select("id", "acousticness", "danceability", "energy",
                                                         "instrumentalness", "liveness", "loudness", "speechiness",
                                                         "tempo", "valence")),
        "items/duration": U.describe_strings(items, "duration_ms"),
        "items/mode": U.frequency(items, "mode"),
    }
    for name, df in out.items():
        SK.write_csv(df, f"{out_dir}/{name}")


def collect_features(
    spark: SparkSession,
    dump_path: str,
    items_path: str,
    creators_path: str,
    out_dir: str,
    named_creator: str,
) -> DataFrame:
    """C1-C5 + D6: popularity-level aggregates as CSV, the feature table and
    its label correlations as Parquet. Returns the feature table (read back)."""
    # The dump is JSON text: parse it once into Parquet (collections without
    # their items, and the exploded items), then every aggregate below reads
    # only the columns it needs from those files.
    colls = load_collections(spark, dump_path)
    SK.write_parquet(colls.drop("tracks"), f"{out_dir}/_work/collections")
    SK.write_parquet(occurrences(colls), f"{out_dir}/_work/occurrences")
    colls = spark.read.parquet(f"{out_dir}/_work/collections")
    occ = spark.read.parquet(f"{out_dir}/_work/occurrences")
    items = materialize(load_items(spark, items_path))
    creators = materialize(load_creators(spark, creators_path))
    for stat in ("mean", "median"):
        agg = R.item_feature_rollup(occ.select("pid", LABEL, "track_uri"), items, AUDIO_FEATURES, stat, "popularity")
        SK.write_csv(agg, f"{out_dir}/aggregated_audio_{stat}")
    SK.write_csv(R.main_features_by_popularity(colls), f"{out_dir}/main_features")
    genres = R.genre_count_per_collection(occ.select("pid", LABEL, "artist_uri"), creators)
    SK.write_csv(R.genre_count_by_popularity(genres), f"{out_dir}/genres_per_followers")
    named = R.named_value_count_per_collection(occ, colls.select("pid", LABEL), named_creator)
    SK.write_csv(R.named_value_by_popularity(named), f"{out_dir}/named_creator")

    audio = R.item_feature_rollup(occ.select("pid", LABEL, "track_uri"), items, AUDIO_FEATURES, "mean", "collection")
    main = colls.select("pid", "num_tracks", "num_artists", "num_albums")
    table = R.feature_table(audio, main, genres.drop(LABEL))
    SK.write_parquet(table, f"{out_dir}/feature_table")
    table = spark.read.parquet(f"{out_dir}/feature_table")
    SK.write_parquet(A.corr_with_label(table, LABEL, MODEL_FEATURES), f"{out_dir}/correlations")
    return table


def model(
    spark: SparkSession,
    feature_table: DataFrame,
    out_dir: str,
    remove_outliers: bool = True,
    remove_skewness: bool = True,
    undersampling: bool = True,
    features: Sequence[str] = MODEL_FEATURES,
    grid: dict | None = None,
    majority=1.0,
    minority=2.0,
) -> DataFrame:
    """Prepare, split, baseline, cross-validated forest, report,
    scored predictions (headerless CSV) and the saved model. Returns the
    metrics table (model and baseline on train and test)."""
    prepared = M.prepare(feature_table, LABEL, remove_outliers, remove_skewness, undersampling, majority, minority)
    prepared = prepared.where(F.col(LABEL).isNotNull())
    SK.write_parquet(prepared, f"{out_dir}/_work/prepared")
    prepared = spark.read.parquet(f"{out_dir}/_work/prepared")
    train, test = M.hash_split(prepared)
    train, test = M.with_baseline(train, test, LABEL)
    cv_model, forest, params = M.grid_search(train, features, LABEL, **(grid or {}))
    SK.write_csv(M.cv_report(spark, cv_model, forest, params), f"{out_dir}/cv_report")
    SK.write_csv(M.importances(spark, cv_model.bestModel, features), f"{out_dir}/importances")
    SK.save_model(cv_model, f"{out_dir}/model")
    scored = {"train": cv_model.transform(train), "test": cv_model.transform(test)}
    for name, df in scored.items():
        out = df.select("pid", LABEL, "prediction", "baseline_prediction")
        SK.write_csv(out, f"{out_dir}/predictions/{name}", header=False)
    parts = [
        M.metrics_for_predictions(df, LABEL, ["prediction", "baseline_prediction"]).select(F.lit(name).alias("set"), "*")
        for name, df in scored.items()
    ]
    return parts[0].unionByName(parts[1])
