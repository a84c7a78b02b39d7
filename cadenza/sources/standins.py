"""Stand-in collections built from the driver tables (TPC-H-like parquet).

The library's operators are written for nested collections of items
(collections hold items by creators, items have numeric features, creators
have genre lists). The test tables do not have that shape, so this module
derives it with plain DataFrame operations; the SQL oracle builds the very
same stand-ins (``cadenza.plans.oracle``).

Mapping (fixed, shared with the oracle):

==================  =====================================================
collection ``pid``   ``orders.o_orderkey``
item occurrence      one ``lineitem`` row: ``pos`` = ``l_linenumber``,
                     ``track_uri`` = ``'track:' || l_partkey``,
                     ``artist_uri`` = ``'artist:' || l_suppkey``; keys that
                     are multiples of 10 (of 7) get ``'track:-'``
                     (``'artist:-'``) uris, which no item (creator) has
                     ``duration_ms`` = ``l_quantity``
``num_followers``    number of orders of the order's customer
num_tracks/artists/  count of lines, distinct ``l_suppkey``, distinct
albums               ``p_brand``
item features        ``part`` (``p_size``, ``p_retailprice``)
creators             ``supplier``; genres = the first ``s_suppkey % 6`` names
                     of GENRE_NAMES (0 gives [])
collection name      ``o_orderpriority``; collaborative = ``o_orderstatus``
description          ``documents.text`` where ``doc_id = o_orderkey``, else NULL
modified_at          ``o_orderdate`` as epoch seconds
==================  =====================================================

None of these builders caps, samples or filters rows: all tables are read
whole. The uris that no row has make the unmatched left-join rows that the
reference's data has (items with no feature row, creators with no row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the stand-in mapping (the oracle SQL uses the same ones).
GENRE_NAMES = ["rock", "pop", "jazz", "folk", "blues"]
NO_FEATURE_MODULUS = 10
NO_CREATOR_MODULUS = 7
TRACK_PREFIX = "track:"
ARTIST_PREFIX = "artist:"

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _track_uri(key: Column) -> Column:
    return F.concat(F.lit(TRACK_PREFIX), key.cast("string"))


def _artist_uri(key: Column) -> Column:
    return F.concat(F.lit(ARTIST_PREFIX), key.cast("string"))


def _occurrence_uri(key: Column, prefix: str, none_every: int) -> Column:
    """The uri an occurrence names; for multiples of ``none_every`` one that no row has."""
    mark = F.when(key % none_every == 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(F.lit(prefix), mark, key.cast("string"))


def followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, num_followers): orders per customer (partial aggregation)."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("num_followers"))
    )


def collection_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, num_followers) for every collection, with or without items."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(followers(spark, sf_dir), "o_custkey").select(
        F.col("o_orderkey").alias("pid"), "num_followers"
    )


def item_occurrences(
    spark: SparkSession, sf_dir: str, with_names: bool = False, with_album: bool = False, with_label: bool = True
) -> DataFrame:
    """Flat form of ``explode(tracks)`` beside its parents.

    (pid, pos, track_uri, artist_uri, duration_ms[, num_followers][,
    track_name, album_name, artist_name]). Collections without items have no
    row, as with the reference's inner explode (trap T2). What a query doesn't
    ask for isn't joined: the label needs the orders, names need the item and
    creator tables, the album alone the item table.
    """
    li = table(spark, sf_dir, "lineitem")
    occ = li.select(
        F.col("l_orderkey").alias("pid"),
        F.col("l_linenumber").alias("pos"),
        _occurrence_uri(F.col("l_partkey"), TRACK_PREFIX, NO_FEATURE_MODULUS).alias("track_uri"),
        _occurrence_uri(F.col("l_suppkey"), ARTIST_PREFIX, NO_CREATOR_MODULUS).alias("artist_uri"),
        F.col("l_quantity").alias("duration_ms"),
        "l_partkey",
        "l_suppkey",
    )
    if with_label:
        occ = occ.join(collection_heads(spark, sf_dir), "pid")
    if with_album:
        album = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("album_name"))
        occ = occ.join(album, "l_partkey", "left")
    if with_names:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_name").alias("track_name"),
            F.col("p_brand").alias("album_name"),
        )
        supp = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("artist_name")
        )
        occ = occ.join(part, "l_partkey", "left").join(supp, "l_suppkey", "left")
    return occ.drop("l_partkey", "l_suppkey")


def item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uri, id, p_size, p_retailprice): the item feature table."""
    part = table(spark, sf_dir, "part")
    return part.select(
        _track_uri(F.col("p_partkey")).alias("uri"),
        F.col("p_partkey").cast("string").alias("id"),
        "p_size",
        "p_retailprice",
    )


def creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(genres, id, name, uri): the creator table with genre arrays."""
    supp = table(spark, sf_dir, "supplier")
    genres = F.array(*[F.lit(g) for g in GENRE_NAMES])
    return supp.select(
        F.slice(genres, F.lit(1), (F.col("s_suppkey") % 6).cast("int")).alias("genres"),
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        _artist_uri(F.col("s_suppkey")).alias("uri"),
    )


def collections(spark: SparkSession, sf_dir: str, counts: bool = True, description: bool = True) -> DataFrame:
    """Flat collection records, one per ``pid`` (the exploded dump, P1).

    Without ``counts`` the item counts and duration, without ``description``
    that column are left out, and the tables they need aren't read.
    """
    heads = table(spark, sf_dir, "orders").join(followers(spark, sf_dir), "o_custkey").select(
        F.col("o_orderkey").alias("pid"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("collaborative"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("modified_at"),
        "num_followers",
    )
    order = ["pid", "name", "description", "collaborative", "modified_at", "num_tracks", "num_artists", "num_albums", "duration_ms", "num_followers"]
    if description:
        docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pid"), F.col("text").alias("description"))
        heads = heads.join(docs, "pid", "left")
    if not counts:
        return heads.select(*[c for c in order if c in heads.columns])
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    # An order's lines are one record, so its distinct keys are a set of that size; counting them
    # as separate distinct aggregates would send every line three times.
    per_order = (
        li.join(brands, "l_partkey", "left")
        .drop("l_partkey")
        .repartition("l_orderkey")
        .groupBy(F.col("l_orderkey").alias("pid"))
        .agg(
            F.count(F.lit(1)).alias("num_tracks"),
            F.size(F.collect_set("l_suppkey")).cast("long").alias("num_artists"),
            F.size(F.collect_set("p_brand")).cast("long").alias("num_albums"),
            F.sum("l_quantity").alias("duration_ms"),
        )
    )
    out = heads.join(per_order, "pid", "left").fillna(0, ["num_tracks", "num_artists", "num_albums"])
    out = out.withColumn("duration_ms", F.coalesce("duration_ms", F.lit(0.0)))
    return out.select(*[c for c in order if c in out.columns])


def _in_part(key: Column, collections_per_doc: int, part: tuple[int, int]) -> Column:
    """Whether the document that a key belongs to is of part ``i`` of ``n``: its number modulo ``n`` is ``i`` (without a number: part 0)."""
    i, n = part
    return F.coalesce(F.pmod(F.floor(key / collections_per_doc), F.lit(n)), F.lit(0)) == i


def count_documents(spark: SparkSession, sf_dir: str, collections_per_doc: int) -> int:
    """How many documents with a number ``playlist_dump`` has."""
    return table(spark, sf_dir, "orders").select(F.count_distinct(F.floor(F.col("o_orderkey") / collections_per_doc))).first()[0]


def nested_collections(spark: SparkSession, sf_dir: str, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Collections in the reference's nested shape: a ``tracks`` array of structs.

    One record per ``pid`` with all its items, as in the reference's input;
    the array is sorted on all fields so its order is deterministic.
    Collections without items have an empty array (the reference's empty
    ``tracks`` case). ``wanted`` tells by the key which collections (all).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    if wanted is not None:
        li = li.where(wanted(F.col("l_orderkey")))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("track_name"), F.col("p_brand").alias("album_name"))
    # One row per key, with all its names, so that a line stays one row, which is what the counts need.
    supp = table(spark, sf_dir, "supplier").groupBy(F.col("s_suppkey").alias("l_suppkey")).agg(F.collect_list(F.struct("s_name")).alias("names"))
    # The smaller side of both joins beside the grouping is hashed: a sort of the wide rows would take
    # as much of a task's memory again as the grouping does.
    lines = li.join(supp, "l_suppkey", "left").join(part.hint("shuffle_hash"), "l_partkey", "left")
    # Each line is sent by its record's key once, as it is; uris and counts are made of the record.
    line = F.struct("l_linenumber", "l_partkey", "track_name", "l_suppkey", "names", "album_name", "l_quantity")
    chunks = lines.groupBy(F.col("l_orderkey").alias("pid")).agg(F.collect_list(line).alias("lines"))

    def tracks_of(x: Column) -> Column:
        uris = _occurrence_uri(x["l_partkey"], TRACK_PREFIX, NO_FEATURE_MODULUS), _occurrence_uri(x["l_suppkey"], ARTIST_PREFIX, NO_CREATOR_MODULUS)
        return F.transform(
            F.coalesce(x["names"], F.array(F.struct(F.lit(None).cast("string").alias("s_name")))),
            lambda n: F.struct(
                x["l_linenumber"].cast("long").alias("pos"),
                uris[0].alias("track_uri"),
                x["track_name"].alias("track_name"),
                uris[1].alias("artist_uri"),
                n["s_name"].alias("artist_name"),
                x["album_name"].alias("album_name"),
                x["l_quantity"].cast("long").alias("duration_ms"),
            ),
        )

    distinct = lambda c: F.size(F.array_compact(F.array_distinct(F.col(f"lines.{c}")))).cast("long")
    chunks = chunks.select(
        "pid",
        F.size("lines").cast("long").alias("num_tracks"),
        distinct("l_suppkey").alias("num_artists"),
        distinct("album_name").alias("num_albums"),
        F.flatten(F.transform("lines", tracks_of)).alias("tracks"),
    )
    # Rows of one key have all the occurrences of that key, once for each such row.
    heads = collections(spark, sf_dir, counts=False, description=False)
    if wanted is not None:
        heads = heads.where(wanted(F.col("pid")))
    heads = heads.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy("pid")))
    repeated = F.when(F.col("_rows") == 1, F.col("tracks")).otherwise(F.flatten(F.array_repeat("tracks", F.col("_rows").cast("int"))))
    return heads.hint("shuffle_hash").join(chunks, "pid", "left").select(
        "pid",
        "name",
        "collaborative",
        "modified_at",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("num_tracks", "num_artists", "num_albums")],
        "num_followers",
        F.coalesce(F.array_sort(repeated), F.array().cast(chunks.schema["tracks"].dataType)).alias("tracks"),
    )


def playlist_dump(spark: SparkSession, sf_dir: str, collections_per_doc: int = 1000, part: tuple[int, int] | None = None) -> DataFrame:
    """The reference's input document shape: ``info`` + ``playlists`` array.

    One document per block of ``collections_per_doc`` consecutive pids. With ``part`` (i, n) the documents
    of the i-th of n parts, from 0 on; the parts together are all documents, each in one part.
    """
    nested = nested_collections(spark, sf_dir, None if part is None else lambda key: _in_part(key, collections_per_doc, part))
    rec = F.struct(*[c for c in nested.columns])
    return (
        nested.withColumn("slice", F.floor(F.col("pid") / collections_per_doc))
        .groupBy("slice")
        .agg(F.array_sort(F.collect_list(rec)).alias("playlists"))
        .select(F.create_map(F.lit("slice"), F.col("slice").cast("string")).alias("info"), "playlists")
    )
