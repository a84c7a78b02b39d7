"""Operator semantics on hand-made rows: the traps of the reference (T*) and
edge rules (bin closure, interpolation, tie handling)."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cadenza.operators import association as A
from cadenza.operators import batching as B
from cadenza.operators import distribution as D
from cadenza.operators import modeling as M
from cadenza.operators import nested as N
from cadenza.operators import quality as Q
from cadenza.operators import rollup as R
from cadenza.operators import univariate as U
from cadenza.operators.indexing import with_row_index
from cadenza.operators.quantiles import percentiles_long, percentiles_wide

TRACKS = "array<struct<pos:bigint,track_uri:string,artist_uri:string,album_name:string,track_name:string,duration_ms:bigint>>"


@pytest.fixture(scope="module")
def nested(spark):
    rows = [
        (1, 5, [(0, "t:1", "a:1", "al", "one", 1000), (1, "t:1", "a:2", "al", "one", 2000)]),
        (2, 1, []),
        (3, 1, None),
    ]
    return spark.createDataFrame(rows, f"pid bigint, num_followers bigint, tracks {TRACKS}")


def test_keep_nested_fields_keeps_listed_fields_in_order(nested):  # T1
    kept = N.keep_nested_fields(nested, "tracks", ["track_uri", "album_name"])
    elem = kept.schema["tracks"].dataType.elementType
    assert [f.name for f in elem.fields] == ["track_uri", "album_name"]


def test_drop_nested_fields_removes_fields(nested):
    dropped = N.drop_nested_fields(nested, "tracks", ["album_name", "track_name"])
    names = [f.name for f in dropped.schema["tracks"].dataType.elementType.fields]
    assert names == ["pos", "track_uri", "artist_uri", "duration_ms"]


def test_inner_explode_drops_empty_and_null(nested):  # T2
    inner = N.explode_beside(nested, "tracks", ["pid"])
    outer = N.explode_beside(nested, "tracks", ["pid"], outer=True)
    assert sorted(r.pid for r in inner.collect()) == [1, 1]
    assert sorted(r.pid for r in outer.collect()) == [1, 1, 2, 3]


def test_total_and_count_matching(nested):  # A13, X6, X7
    out = nested.select(
        "pid",
        N.total_of_field("tracks", "duration_ms").alias("total"),
        N.count_matching("tracks.artist_uri", "a:2").alias("n"),
        N.contains_flag("tracks.artist_uri", "a:2").alias("flag"),
    ).orderBy("pid").collect()
    assert [(r.total, r.n, r.flag) for r in out[:2]] == [(3000, 1, 1), (0, 0, 0)]


def test_genre_missing_modes(spark):  # T3
    occ = spark.createDataFrame(
        [(1, "a:1", 1), (1, "a:2", 1), (1, "a:3", 1)], "pid bigint, artist_uri string, num_followers bigint"
    )
    creators = spark.createDataFrame([(["x", "y"], "a:1"), ([], "a:2")], "genres array<string>, uri string")

    def mean(mode):
        return R.genre_count_per_collection(occ, creators, mode).first().genre_count

    assert mean("null") == pytest.approx(1.0)  # (2 + 0) / 2, unmatched ignored
    assert mean("minus_one") == pytest.approx(1 / 3)  # (2 + 0 - 1) / 3
    assert mean("nonempty") == pytest.approx(2.0)


def test_corr_null_rules(spark):  # T4
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None), (4.0, 4.0)], "y double, x double")
    skip = A.corr_with_label(df, "y", ["x"]).first().correlation
    zero = A.corr_with_label(df, "y", ["x"], null_as_zero=True).first().correlation
    assert skip == pytest.approx(1.0)
    assert zero == pytest.approx(0.5291502622, rel=1e-9)  # corr([1,2,3,4], [1,2,0,4])


def test_quality_always_returns_rows(spark):  # T5
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    rows = Q.null_counts(df, ["id", "name"]).collect()
    assert {r.column: (r.null_count, r.has_nulls) for r in rows} == {"id": (0, False), "name": (0, False)}


def test_duplicates_count_null_as_value(spark):  # Q5
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "v string")
    assert Q.duplicate_value_counts(df, ["v"]).first().duplicated_values == 2


def test_tokenizer_keeps_blank_tokens(spark):  # T7
    df = spark.createDataFrame([(" a  b ",), (None,), ("",)], "name string")
    got = {r.word: r["count"] for r in U.word_counts(df, "name").collect()}
    assert got == {"": 3, "a": 1, "b": 1}
    got = {r.word: r["count"] for r in U.word_counts(df, "name", drop_empty=True).collect()}
    assert got == {"a": 1, "b": 1}


def test_log_of_non_positive_is_null(spark):  # T9
    df = spark.createDataFrame([(1, 0.0), (2, math.e)], "pid bigint, num_followers double")
    out = {r.pid: r.num_followers for r in M.log_target(df, "num_followers").collect()}
    assert out[1] is None and out[2] == pytest.approx(1.0)


def test_undersampling_clamps_fraction(spark):  # T10
    rows = [(i, 1.0) for i in range(3)] + [(100 + i, 2.0) for i in range(10)] + [(200, 0.5)]
    df = spark.createDataFrame(rows, "pid bigint, label double")
    out = M.undersample(df, "label", 1.0, 2.0, key="pid")
    labels = sorted(r.label for r in out.collect())
    assert labels.count(1.0) == 3 and labels.count(2.0) == 10 and labels.count(0.5) == 1


def test_undersampling_without_majority_rows(spark):  # T10, n(majority) = 0
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "pid bigint, label double")
    assert M.undersample(df, "label", 1.0, 2.0).count() == 2


def test_id_batches_keep_last_partial_batch(spark):  # T13
    ids = spark.createDataFrame([(f"{i:04d}",) for i in range(250)], "id string")
    rows = B.id_batches(ids, batch_size=100, batches_per_file=2).orderBy("batch").collect()
    assert [r.n_ids for r in rows] == [100, 100, 50]
    assert rows[2].file == 1
    assert rows[0].ids.split(",")[:2] == ["0000", "0001"]


@pytest.mark.parametrize("range_rows", [None, 40, 7])
def test_row_index_matches_row_number(spark, range_rows):  # W2
    rnd = random.Random(3)
    rows = [(i, None if i % 50 == 0 else float(rnd.randint(0, 20))) for i in range(500)]
    df = spark.createDataFrame(rows, "pid bigint, y double").repartition(7)
    got = {r.pid: r.idx for r in with_row_index(df, [F.col("y"), F.col("pid")], "idx", range_rows).collect()}
    want = {pid: i for i, (pid, _) in enumerate(sorted(rows, key=lambda t: (t[1] is not None, t[1] or 0, t[0])))}
    assert got == want
    assert with_row_index(df.where("pid < 0"), ["y", "pid"], "idx", range_rows).count() == 0


def _py_percentile(vals, p):
    vals = sorted(vals)
    pos = (len(vals) - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    return vals[lo] if lo == hi else (hi - pos) * vals[lo] + (pos - lo) * vals[hi]


@pytest.mark.parametrize("buckets,levels", [(64, 2), (16, 1), (4, 3), (2, 1)])
def test_percentiles_exact_with_a_hot_group(spark, buckets, levels):
    rnd = random.Random(7)
    # Group 1 holds most rows (the hot popularity level), with many distinct values; a NULL group is one too.
    rows = [(1, rnd.random() * 100) for _ in range(3000)] + [(g, float(rnd.randint(0, 9))) for g in (None, *range(2, 9)) for _ in range(30)]
    rows += [(9, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.25, 0.5, 0.9]
    out = percentiles_long(df, ["g"], ["v"], probs, buckets=buckets, levels=levels)
    got = {(r.g, r.p): r.value for r in out.collect()}
    for g in (None, *range(1, 9)):
        vals = [v for gg, v in rows if gg == g and v is not None]
        for p in probs:
            assert got[(g, p)] == pytest.approx(_py_percentile(vals, p), rel=1e-12)
    assert not any(k[0] == 9 for k in got)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_percentiles_of_nan_and_null_groups_agree_with_builtin(spark, levels):
    nan = float("nan")
    rows = [(1, 1.0), (1, nan), (1, nan), (2, nan), (None, 2.0), (None, 4.0), (None, None), (3, None), (4, -1.0), (4, nan), (4, 0.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    for p in (0.0, 0.5, 0.6, 1.0):
        want = {r.g: r.v for r in percentiles_wide(df, ["g"], ["v"], p, method="builtin").collect()}
        got = {r.g: r.v for r in percentiles_wide(df, ["g"], ["v"], p, buckets=4, levels=levels).collect()}
        assert str(sorted(got.items(), key=str)) == str(sorted(want.items(), key=str))
        assert set(got) == {1, 2, 3, 4, None}


def test_percentiles_wide_keeps_all_null_groups(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, None)], "g int, v double")
    got = {r.g: r.v for r in percentiles_wide(df, ["g"], ["v"]).collect()}
    assert got == {1: 2.0, 2: None}


def test_equal_width_histogram_closes_last_bin(spark):  # D1
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    rows = D.equal_width_histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 2, 1, 0, 1]
    assert sum(r["count"] for r in rows) == 6


def test_integer_histogram_puts_max_in_last_bin(spark):  # D2
    df = spark.createDataFrame([(x,) for x in [0, 1, 1, 3]], "x int")
    got = {r.bin: r["count"] for r in D.integer_histogram(df, "x").collect()}
    gap = spark.createDataFrame([(0,), (1,), (6,), (None,)], "x int")
    assert {r.bin: r["count"] for r in D.integer_histogram(gap, "x").collect()} == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 1}
    assert D.integer_histogram(gap.where("x is null"), "x").count() == 0
    assert got == {0: 1, 1: 2, 2: 1}


def test_integer_histogram_of_negative_values_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK_BINS", 4)
    values = [-9, -9, -4, -1, 0, 3, 4, 11, 12, 12]
    df = spark.createDataFrame([(x,) for x in values], "x int")
    got = {r.bin: r["count"] for r in D.integer_histogram(df, "x").collect()}
    want = {b: 0 for b in range(12)} | {-9: 2, -4: 1, -1: 1, 0: 1, 3: 1, 4: 1, 11: 3}
    assert got == want
    assert {r.bin: r["count"] for r in D.integer_histogram(df.where("x < 0"), "x").collect()} == {-9: 2, -4: 1, -1: 1, 0: 0}


def test_integer_histogram_of_a_huge_maximum(spark):
    df = spark.createDataFrame([(7,), (100_000_000,), (99_999_999,)], "x int")
    row = D.integer_histogram(df, "x").agg(F.count("*").alias("bins"), F.sum("count").alias("n"), F.max("bin").alias("last"), F.sum(F.when(F.col("bin").isin(7, 99_999_999), F.col("count"))).alias("own")).first()
    assert tuple(row) == (100_000_000, 3, 99_999_999, 3)


def test_quartiles_are_right_closed_and_ties_share(spark):  # D5
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 2, 3, 4, 5]], "y double")
    got = {r.y: r.quartile for r in A.with_quartile(df, "y").collect()}
    assert got[1.0] == "Q1"  # all four 1s together, not split as ntile would


def test_shares_sum_to_one(spark):  # W1
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sum(r.share for r in U.shares(U.frequency(df, "k")).collect()) == pytest.approx(1.0)


def test_baseline_r2_on_own_training_set_is_zero(spark):  # M6
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "pid bigint, y double")
    train, test = M.with_baseline(df, df, "y")
    m = M.regression_metrics(train, "y", "baseline_prediction").first()
    assert m.r2 == pytest.approx(0.0, abs=1e-12)


def test_boxplot_whiskers(spark):  # D3
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    row = D.boxplot_summary(df, ["x"]).first()
    assert (row.q1, row.median, row.q3) == (3.0, 5.0, 7.0)
    assert row.upper_whisker == 8.0 and row.outliers == 1


def test_rename_nested_aggregates(spark):  # P12
    df = spark.createDataFrame([(1.0, 2.0)], "`avg(avg(x))` double, y double")
    assert A.rename_nested_aggregates(df).columns == ["x", "y"]


def test_multiline_document_source(spark, tmp_path):  # S1, P1
    import json

    from cadenza import schemas
    from cadenza.sources.readers import read_nested_json

    doc = {
        "info": {"slice": "0"},
        "playlists": [
            {"pid": 7, "name": " road  trip ", "num_followers": 2, "tracks": [{"pos": 0, "track_uri": "t:1"}]},
            {"pid": 8, "name": None, "num_followers": 1, "tracks": []},
        ],
    }
    (tmp_path / "part-0.json").write_text(json.dumps(doc, indent=2))
    dump = read_nested_json(spark, str(tmp_path), schemas.DUMP, multi_line=True)
    recs = N.explode_records(dump)
    assert sorted(r.pid for r in recs.collect()) == [7, 8]
    flat = N.explode_beside(recs, "tracks", ["pid"], ["track_uri"]).collect()
    assert [(r.pid, r.track_uri) for r in flat] == [(7, "t:1")]


@pytest.mark.parametrize("buckets", [2, 8, 64])
def test_percentiles_wide_paths_agree_with_builtin(spark, buckets):
    rnd = random.Random(11)
    rows = [(1, rnd.random(), float(rnd.randint(0, 3))) for _ in range(400)]
    rows += [(2, None, 1.0), (3, None, None), (4, 2.5, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    want = {r.g: (r.a, r.b) for r in percentiles_wide(df, ["g"], ["a", "b"], 0.5, method="builtin").collect()}
    got = {r.g: (r.a, r.b) for r in percentiles_wide(df, ["g"], ["a", "b"], 0.5, buckets=buckets).collect()}
    assert set(got) == set(want) == {1, 2, 3, 4}
    for g in want:
        for x, y in zip(got[g], want[g]):
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-12)


def test_key_split_mixes_consecutive_keys(spark):  # M4, T11
    df = spark.range(2000).select(F.col("id").alias("pid")).union(spark.sql("select cast(null as bigint)"))
    train, test = M.hash_split(df)
    test_keys = sorted(r.pid for r in test.collect() if r.pid is not None)
    assert 340 <= len(test_keys) <= 460
    # every block of 200 consecutive keys has its share of test rows
    assert all(20 <= sum(k // 200 == b for k in test_keys) <= 60 for b in range(10))
    assert train.count() + test.count() == 2001  # a NULL key is in one set


def test_sampling_and_splitting_are_independent(spark):  # M2, M4
    df = spark.range(40000).select(
        F.col("id").alias("pid"), F.when(F.col("id") % 10 < 6, 1.0).when(F.col("id") % 10 < 9, 2.0).when(F.col("id") % 100 == 9, None).otherwise(0.5).alias("y")
    )
    kept = M.undersample(df, "y", 1.0, 2.0)  # fraction 0.5
    sizes = {r.y: r["count"] for r in kept.groupBy("y").count().collect()}
    assert abs(sizes[1.0] / 12000 - 1) < 0.05 and sizes[2.0] == 12000 and sizes[0.5] + sizes[None] == 4000
    _, test = M.hash_split(kept)
    shares = {r.y: r["count"] / sizes[r.y] for r in test.groupBy("y").count().collect()}
    assert all(abs(s - 0.2) < 0.03 for y, s in shares.items() if sizes[y] > 1000)


def test_report_marks_the_best_point_by_the_metrics_direction(spark):  # M12
    df = spark.createDataFrame([(float(i % 7), float(i % 3), float(i % 7) * 2) for i in range(80)], "a double, b double, y double")
    for metric, pick in (("rmse", min), ("r2", max)):
        cv, forest, grid = M.grid_search(df, ["a", "b"], "y", (1, 4), (1.0,), (1, 30), ("all",), folds=2, metric=metric)
        rows = M.cv_report(spark, cv, forest, grid).collect()
        assert [r.cv_metric for r in rows if r.is_best] == [pick(r.cv_metric for r in rows)]


def test_scoring_keeps_rows_with_null_features(spark):  # M13, T12
    df = spark.createDataFrame([(i, float(i % 5), None if i % 4 == 0 else 1.0, float(i % 5)) for i in range(60)], "pid long, a double, b double, y double")
    train, test = M.with_baseline(df, df, "y")
    model = M.forest_pipeline(["a", "b"], "y", M.ForestSpec(num_trees=2))[0].fit(train)
    assert M.score(model, test, "pid", "y").where("prediction is not null").count() == 60


def test_nested_collection_is_one_record_whatever_its_size(spark, tmp_path):  # P2
    from cadenza.sources import standins as S

    def write(name, sql):
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")

    write("orders", "select 1L o_orderkey, 7L o_custkey, 'p' o_orderpriority, 'O' o_orderstatus, date'2020-01-01' o_orderdate")
    write("lineitem", "select 1L l_orderkey, cast(id + 1 as int) l_linenumber, id % 50 l_partkey, id % 10 l_suppkey, 1.0D l_quantity from range(300)")
    write("part", "select id p_partkey, 'n' p_name, 'b' p_brand, 1 p_size, 1.0D p_retailprice from range(50)")
    write("supplier", "select id s_suppkey, 'n' s_name from range(10)")
    write("documents", "select 1L doc_id, 'text' text")
    rows = S.nested_collections(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and len(rows[0].tracks) == 300


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _small_tables(spark, path, orders="select id o_orderkey, id % 3 o_custkey, 'p' o_orderpriority, 'O' o_orderstatus, date'2020-01-01' o_orderdate from range(6)"):
    def write(name, sql):
        spark.sql(sql).write.parquet(f"{path}/{name}.parquet")

    write("orders", orders)
    write("lineitem", "select id % 5 l_orderkey, cast(id as int) l_linenumber, if(id % 4 = 0, null, id % 7) l_partkey, if(id % 6 = 0, null, id % 3) l_suppkey, 2.0D l_quantity from range(40)")
    write("part", "select id p_partkey, 'n' p_name, if(id = 2, null, concat('b', id % 2)) p_brand, 1 p_size, 1.0D p_retailprice from range(5)")
    write("supplier", "select id % 2 s_suppkey, if(id = 1, null, concat('s', id)) s_name from range(4)")
    return str(path)


def test_counts_of_a_collection_send_a_line_once(spark, tmp_path):  # F8
    from cadenza.sources import standins as S

    d = _small_tables(spark, tmp_path)
    got = S.collections(spark, d, description=False)
    assert "Expand" not in _plan(got)
    lines = spark.read.parquet(f"{d}/lineitem.parquet").join(spark.read.parquet(f"{d}/part.parquet"), F.expr("l_partkey = p_partkey"), "left")
    want = {r[0]: tuple(r)[1:] for r in lines.groupBy("l_orderkey").agg(F.count("*"), F.count_distinct("l_suppkey"), F.count_distinct("p_brand"), F.sum("l_quantity")).collect()}
    rows = {r.pid: (r.num_tracks, r.num_artists, r.num_albums, r.duration_ms) for r in got.collect()}
    assert rows == {pid: want.get(pid, (0, 0, 0, 0.0)) for pid in range(6)}


def test_quartiles_read_their_rows_once(spark):  # F8
    made = spark.range(50).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    out = U.describe_quartiles(made, ["a", "b"])
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["column"]: (r["count"], r.p50) for r in out.collect()} == {"a": (50, 3.0), "b": (50, 24.5)}


def test_nested_collections_send_lines_as_they_are(spark, tmp_path):  # F5 F6 F7 F9
    from cadenza.sources import standins as S

    d = _small_tables(spark, tmp_path, "select id % 5 o_orderkey, id % 3 o_custkey, 'p' o_orderpriority, 'O' o_orderstatus, date'2020-01-01' o_orderdate from range(6)")
    nested = S.nested_collections(spark, d)
    # The lines are read once, and a record's tracks aren't sorted by its key again.
    plan = _plan(nested)
    assert plan.count("l_linenumber:") == 1 and plan.count("l_quantity:") == 1 and "SortMergeJoin [pid" not in plan
    # As rows of a flat join; key 0 has two heads, each of which has its lines twice.
    flat = S.item_occurrences(spark, d, with_names=True)
    track = F.struct(F.col("pos").cast("long").alias("pos"), "track_uri", "track_name", "artist_uri", "artist_name", "album_name", F.col("duration_ms").cast("long").alias("duration_ms"))
    want = {r.pid: r.t for r in flat.groupBy("pid").agg(F.array_sort(F.collect_list(track)).alias("t")).collect()}
    counts = {r.pid: (r.num_tracks, r.num_artists, r.num_albums) for r in S.collections(spark, d, description=False).collect()}
    rows = nested.collect()
    assert len(rows) == 6 and all(r.tracks == want[r.pid] and (r.num_tracks, r.num_artists, r.num_albums) == counts[r.pid] for r in rows)
    assert len(want[0]) > counts[0][0]


def test_documents_are_written_without_a_shuffle_and_compressed(spark, tmp_path):  # F5 F6 F7
    from cadenza.plans.q_io import _one_file_each
    from cadenza.sources import sinks

    rows = spark.range(0, 6, 1, 3).select(F.col("id").alias("k"), F.lit("x" * 5000).alias("v"))
    _one_file_each(rows, "k", F.col("v"), f"{tmp_path}/docs")
    files = sorted((tmp_path / "docs").rglob("part-*"))
    # One file a row, written by the three tasks that had the rows.
    assert len(files) == 6 and len({f.name.split("-")[1] for f in files}) == 3
    assert all(f.name.endswith(".gz") and f.stat().st_size < 500 for f in files)
    sinks.write_json(rows, f"{tmp_path}/lines", compression="gzip")
    assert spark.read.json(f"{tmp_path}/lines").count() == 6


def test_predictions_are_written_and_ordered_by_many_tasks(spark, tmp_path, monkeypatch):  # F3
    from cadenza import schemas
    from cadenza.sources import readers, sinks

    seen = []
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda df, n: seen.append(n) or pytest.fail("coalesce(1) makes one task do all the work before"))
    rows = spark.range(0, 4000, 1, 4).select(F.col("id").alias("pid"), F.lit(1.0).alias("num_followers"), F.lit(0.5).alias("prediction"), F.lit(0.25).alias("baseline_prediction"))
    sinks.write_csv(rows, f"{tmp_path}/p", header=False, single_file=True)
    assert not seen and len(list((tmp_path / "p").glob("part-*"))) == 1
    back = readers.read_predictions(spark, f"{tmp_path}/p", schemas.PREDICTIONS)
    plan = _plan(back)
    assert re.search(r"rangepartitioning\(num_followers[^,]*, pid", plan)
    assert [r.pid for r in back.collect()] == sorted(range(4000))


def test_checkpoint_folder_must_be_shared(spark):
    from cadenza.session import _one_machine

    assert all(map(_one_machine, ("local", "local[4]", "local[*]")))
    assert not any(map(_one_machine, ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://x")))


def test_describe_strings_on_a_string_column(spark):  # T8
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("c", None)], "id string, x double")
    rows = {r.summary: (r.id, r.x) for r in U.describe_strings(df, "id", "x").collect()}
    assert rows["count"] == ("3", "2")
    assert rows["mean"][0] is None and rows["min"][0] == "a" and rows["max"][0] == "c"
    long = {r.column: r for r in U.describe_long(df, ["x"]).collect()}
    assert long["x"].mean == 2.0 and long["x"]["count"] == 2


def test_metrics_for_predictions_match_single_metrics(spark):  # M6
    rows = [(i, float(i % 5), float(i % 3), None if i % 7 == 0 else 2.0) for i in range(100)]
    df = spark.createDataFrame(rows, "pid bigint, y double, p double, q double")
    multi = {r.predictor: r for r in M.metrics_for_predictions(df, "y", ["p", "q"]).collect()}
    for col in ("p", "q"):
        one = M.regression_metrics(df, "y", col).first()
        assert multi[col].n == one.n
        assert multi[col].rmse == pytest.approx(one.rmse) and multi[col].r2 == pytest.approx(one.r2)


def test_bernoulli_undersampling_is_seeded(spark):  # M2
    df = spark.createDataFrame([(i, 1.0) for i in range(400)] + [(1000 + i, 2.0) for i in range(100)], "pid bigint, label double")
    a = M.undersample(df, "label", 1.0, 2.0, method="bernoulli", seed=3).where("label = 1.0").count()
    b = M.undersample(df, "label", 1.0, 2.0, method="bernoulli", seed=3).where("label = 1.0").count()
    assert a == b and 50 <= a <= 150


def test_scatter_sample_keeps_statistics_whole(spark):  # D9
    df = spark.createDataFrame([(i, float(i % 10), float(1 + i % 4)) for i in range(400)], "pid bigint, x double, y double")
    full = A.scatter_points(df, "pid", "x", "y")
    thin = A.scatter_points(df, "pid", "x", "y", sample_fraction=0.25, seed=1)
    assert full.count() == 400 and 50 < thin.count() < 150
    assert {r.mean_x for r in thin.collect()} == {4.5}


def test_named_value_counts_zero_for_collections_without_items(spark):  # C4
    occ = spark.createDataFrame([(1, "X"), (1, "Y"), (1, "X")], "pid bigint, artist_name string")
    heads = spark.createDataFrame([(1, 3), (2, 3), (3, 1)], "pid bigint, num_followers bigint")
    per = {r.pid: r.value_count for r in R.named_value_count_per_collection(occ, heads, "X").collect()}
    assert per == {1: 2, 2: 0, 3: 0}
    pop = {r.num_followers: r.avg_value_count for r in R.named_value_by_popularity(
        R.named_value_count_per_collection(occ, heads, "X")).collect()}
    assert pop == {3: 1.0, 1: 0.0}


def test_feature_table_takes_label_and_rows_from_the_audio_side(spark):  # C5, T2
    audio = spark.createDataFrame([(1, 2.0, 0.5)], "pid bigint, num_followers double, f double")
    main = spark.createDataFrame([(1, 3, 2, 1), (2, 0, 0, 0)], "pid bigint, num_tracks int, num_artists int, num_albums int")
    genres = spark.createDataFrame([(1, 1.5)], "pid bigint, genre_count double")
    rows = R.feature_table(audio, main, genres).collect()
    assert len(rows) == 1 and rows[0].num_followers == 2.0 and rows[0].genre_count == 1.5
