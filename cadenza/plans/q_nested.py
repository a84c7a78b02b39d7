"""Nested-shape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.scalar import ms_to_minutes, uri_to_id
from cadenza.operators import batching as B
from cadenza.operators import nested as N
from cadenza.plans.catalog import register
from cadenza.plans.oracle import r, with_ctes
from cadenza.plans.q_rollup import NAMED_CREATOR
from cadenza.sources import standins as S

TRACK_FIELDS = ["pos", "track_uri", "track_name", "artist_uri", "artist_name", "album_name", "duration_ms"]
KEPT_FIELDS = ["album_name", "artist_uri", "track_name", "track_uri"]


@register(
    "flatten_tracks",
    with_ctes(["occn"], """SELECT pid, num_followers, CAST(pos AS BIGINT) AS pos, track_uri, track_name, artist_uri,
        artist_name, album_name, CAST(duration_ms AS BIGINT) AS duration_ms FROM occn"""),
    "P1 P2 P3 P7 T2",
)
def flatten_tracks(spark, d):
    dump = S.playlist_dump(spark, d)
    recs = N.explode_records(dump)
    return N.explode_beside(recs, "tracks", ["pid", "num_followers"], TRACK_FIELDS)


@register(
    "nested_field_array_size",
    with_ctes(["heads", "occ"], """SELECT h.pid, coalesce(x.n_items, 0) AS n_items,
        coalesce(x.n_distinct_items, 0) AS n_distinct_items, coalesce(x.n_distinct_creators, 0) AS n_distinct_creators
        FROM heads h LEFT JOIN (SELECT pid, count(*) AS n_items, count(DISTINCT track_uri) AS n_distinct_items,
                                       count(DISTINCT artist_uri) AS n_distinct_creators FROM occ GROUP BY pid) x
        USING (pid)"""),
    "P2 X5 P8",
)
def nested_field_array_size(spark, d):
    nested = S.nested_collections(spark, d)
    return nested.select(
        "pid",
        F.size("tracks").cast("long").alias("n_items"),
        F.size(F.array_distinct(N.field_array("tracks", "track_uri"))).cast("long").alias("n_distinct_items"),
        F.size(F.array_distinct(N.field_array("tracks", "artist_uri"))).cast("long").alias("n_distinct_creators"),
    )


@register(
    "distinct_rows",
    with_ctes(["occ"], "SELECT DISTINCT track_uri, artist_uri FROM occ"),
    "U1 S2",
)
def distinct_rows(spark, d):
    return S.item_occurrences(spark, d, with_label=False).select("track_uri", "artist_uri").distinct()


@register(
    "keep_nested_fields",
    with_ctes(["occn"], "SELECT pid, album_name, artist_uri, track_name, track_uri FROM occn"),
    "P6 T1",
)
def keep_nested_fields(spark, d):
    kept = N.keep_nested_fields(S.nested_collections(spark, d), "tracks", KEPT_FIELDS)
    return N.explode_beside(kept, "tracks", ["pid"])


@register(
    "drop_nested_fields",
    with_ctes(["occn"], """SELECT pid, CAST(pos AS BIGINT) AS pos, track_uri, artist_uri,
        CAST(duration_ms AS BIGINT) AS duration_ms FROM occn"""),
    "P6",
)
def drop_nested_fields(spark, d):
    dropped = N.drop_nested_fields(S.nested_collections(spark, d), "tracks", ["track_name", "artist_name", "album_name"])
    return N.explode_beside(dropped, "tracks", ["pid"])


@register(
    "clean_collections",
    with_ctes(["colls", "occn"], """SELECT c.pid, c.name, c.collaborative, c.num_tracks, c.num_artists, c.num_albums,
        c.num_followers, o.album_name, o.artist_uri, o.track_name, o.track_uri
        FROM colls c JOIN occn o ON o.pid = c.pid"""),
    "C6 P5 P6",
)
def clean_collections(spark, d):
    cleaned = N.clean_collections(S.nested_collections(spark, d))
    keep = [c for c in cleaned.columns if c != "tracks"]
    return N.explode_beside(cleaned, "tracks", keep)


@register(
    "collection_total_duration",
    with_ctes(["heads", "occ"], f"""SELECT h.pid, CAST(coalesce(x.total, 0) AS BIGINT) AS total_duration,
        {r('coalesce(x.total, 0) / 60000.0')} AS total_minutes
        FROM heads h LEFT JOIN (SELECT pid, sum(CAST(duration_ms AS BIGINT)) AS total FROM occ GROUP BY pid) x
        USING (pid)"""),
    "A13 X11",
)
def collection_total_duration(spark, d):
    nested = S.nested_collections(spark, d)
    # One nested record per position block: add the blocks of a collection up.
    per_record = nested.select("pid", N.total_of_field("tracks", "duration_ms").alias("total"))
    per = per_record.groupBy("pid").agg(F.sum("total").alias("total_duration"))
    return per.select("pid", "total_duration", ms_to_minutes("total_duration").alias("total_minutes"))


@register(
    "named_value_flag",
    with_ctes(["heads", "occn"], f"""SELECT num_followers, {r('avg(flag)')} AS share_with_value,
        CAST(sum(flag) AS BIGINT) AS collections_with_value FROM (
          SELECT h.pid, h.num_followers, CASE WHEN x.pid IS NULL THEN 0 ELSE 1 END AS flag
          FROM heads h LEFT JOIN (SELECT DISTINCT pid FROM occn WHERE artist_name = '{NAMED_CREATOR}') x USING (pid)) t
        GROUP BY num_followers"""),
    "X7 X6 F10",
)
def named_value_flag(spark, d):
    nested = S.nested_collections(spark, d)
    flags = nested.select(
        "pid", "num_followers", N.contains_flag("tracks.artist_name", NAMED_CREATOR).alias("flag")
    ).groupBy("pid", "num_followers").agg(F.max("flag").alias("flag"))
    return flags.groupBy("num_followers").agg(
        F.avg("flag").alias("share_with_value"), F.sum("flag").cast("long").alias("collections_with_value")
    )


@register(
    "named_value_count_nested",
    with_ctes(["heads", "occn"], f"""SELECT h.pid, coalesce(x.n, 0) AS value_count
        FROM heads h LEFT JOIN (SELECT pid, count(*) AS n FROM occn WHERE artist_name = '{NAMED_CREATOR}'
                                GROUP BY pid) x USING (pid)"""),
    "X6 F10",
)
def named_value_count_nested(spark, d):
    nested = S.nested_collections(spark, d)
    per = nested.select("pid", N.count_matching("tracks.artist_name", NAMED_CREATOR).alias("n"))
    return per.groupBy("pid").agg(F.sum("n").cast("long").alias("value_count"))


@register(
    "distinct_item_ids",
    with_ctes(["occ"], "SELECT DISTINCT substr(track_uri, 7) AS id FROM occ"),
    "P4 X3 U3",
)
def distinct_item_ids(spark, d):
    uris = N.distinct_nested_values(S.playlist_dump(spark, d), "track_uri")
    return uris.select(uri_to_id("track_uri").alias("id")).distinct()


@register(
    "uri_to_id",
    with_ctes(["occ"], "SELECT DISTINCT artist_uri, substr(artist_uri, 8) AS id FROM occ"),
    "X3",
)
def uri_to_id_query(spark, d):
    occ = S.item_occurrences(spark, d, with_label=False).select("artist_uri").distinct()
    return occ.select("artist_uri", uri_to_id("artist_uri").alias("id"))


@register(
    "id_batches",
    with_ctes(["occ"], """SELECT idx // 100 AS batch, idx // 10000 AS file, count(*) AS n_ids,
            string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx
              FROM (SELECT DISTINCT substr(track_uri, 7) AS id FROM occ) u) t
        GROUP BY 1, 2""", ),
    "C7 O4 X4 T13",
)
def id_batches(spark, d):
    ids = B.distinct_ids(S.item_occurrences(spark, d, with_label=False))
    return B.id_batches(ids, batch_size=100, batches_per_file=100)


@register(
    "cast_and_drop_null_records",
    """SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
              CAST(value AS DOUBLE) AS value
       FROM events
       WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL AND value IS NOT NULL""",
    "P10 F6 F8 X12 T18",
)
def cast_and_drop_null_records(spark, d):
    from cadenza.sources.readers import conform_json_text

    ev = S.table(spark, d, "events")
    parsed = conform_json_text(ev, "props", "k double", keep=["event_id", "event_type", "value"])
    typed = parsed.select("event_id", "event_type", "k", F.col("value").cast("double").alias("value"))
    return typed.dropna(subset=["k", "value"])
