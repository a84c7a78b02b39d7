"""The reference's stages end to end on a small nested JSON fixture."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import modeling as M
from cadenza.plans import flows


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    rnd = random.Random(5)
    (root / "dump").mkdir()
    pid = 0
    for doc in range(2):
        playlists = []
        for _ in range(40):
            n = rnd.randint(0, 6)
            tracks = [
                {"pos": i, "track_uri": f"t:{rnd.randint(0, 30)}", "track_name": "song", "artist_uri": f"a:{rnd.randint(0, 9)}",
                 "artist_name": rnd.choice(["Alpha", "Beta"]), "album_name": f"al{rnd.randint(0, 5)}", "duration_ms": 1000 * (i + 1)}
                for i in range(n)
            ]
            playlists.append({
                "pid": pid, "name": rnd.choice([" road trip", "chill", None, "chill vibes "]), "description": None,
                "collaborative": rnd.choice(["true", "false"]), "modified_at": 1500000000 + 86400 * rnd.randint(0, 40),
                "num_tracks": n, "num_albums": min(n, 3), "num_artists": min(n, 4), "num_edits": rnd.randint(1, 9),
                "num_followers": rnd.choice([1, 1, 1, 2, 2, 3, 5, 40]), "duration_ms": 1000 * n, "tracks": tracks,
            })
            pid += 1
        (root / "dump" / f"slice-{doc}.json").write_text(json.dumps({"info": {"slice": str(doc)}, "playlists": playlists}, indent=1))
    items = []
    for t in range(30):  # t:30 never gets a feature row
        row = {c: rnd.random() for c in ["danceability", "energy", "loudness", "speechiness", "acousticness",
                                         "instrumentalness", "liveness", "valence", "tempo"]}
        row.update({"key": rnd.randint(0, 11), "mode": rnd.randint(0, 1), "duration_ms": rnd.randint(1, 9) * 1000,
                    "time_signature": 4, "type": "audio", "id": str(t), "uri": f"t:{t}", "track_href": f"h{t}",
                    "analysis_url": f"u{t}"})
        items.append(row)
    (root / "items").mkdir()
    (root / "items" / "part-0.json").write_text("\n".join(json.dumps(r) for r in items + items[:5]))
    creators = [{"genres": ["pop", "rock"][: a % 3], "id": str(a), "name": f"n{a}", "uri": f"a:{a}"} for a in range(8)]
    (root / "creators").mkdir()
    (root / "creators" / "part-0.json").write_text("\n".join(json.dumps(r) for r in creators))
    return {k: str(root / k) for k in ["dump", "items", "creators"]}


def test_flows_end_to_end(spark, inputs, tmp_path):
    out = str(tmp_path)
    flows.clean(spark, inputs["dump"], inputs["items"], inputs["creators"], f"{out}/clean")
    cleaned = spark.read.parquet(f"{out}/clean/collections")
    assert cleaned.count() == 80 and "description" not in cleaned.columns
    assert spark.read.parquet(f"{out}/clean/item_features").count() == 30  # duplicates removed

    report = flows.quality(spark, inputs["dump"], inputs["items"], inputs["creators"])
    desc = report.where((F.col("column") == "description") & (F.col("check") == "nulls")).first()
    assert desc.value == 80 and desc.ratio == 1.0

    flows.univariate(spark, inputs["dump"], inputs["items"], inputs["creators"], f"{out}/uni")
    assert spark.read.option("header", True).csv(f"{out}/uni/collections/name_words").count() > 0

    table = flows.collect_features(spark, inputs["dump"], inputs["items"], inputs["creators"], f"{out}/feat", "Alpha")
    with_items = cleaned.where(F.size("tracks") > 0).count()
    assert table.count() == with_items  # collections without items are not in the table (T2)
    assert spark.read.parquet(f"{out}/feat/correlations").count() == len(flows.MODEL_FEATURES)

    grid = dict(num_trees=(4,), subsampling=(1.0,), min_instances=(1,), strategies=("all",), folds=2)
    metrics = flows.model(spark, table, f"{out}/model", grid=grid)  # all preparations, NULL features as they are
    assert metrics.count() == 4
    prepared = spark.read.parquet(f"{out}/model/_work/prepared")
    _, test = M.hash_split(prepared)
    assert spark.read.csv(f"{out}/model/predictions/test").count() == test.count() > 0
