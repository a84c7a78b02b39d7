"""Large documents are written, read and deleted part by part, and the parts are all documents."""

from __future__ import annotations

import os

from cadenza.operators import nested as N
from cadenza.plans import q_io as Q
from cadenza.sources import json_documents as J
from cadenza.sources import standins as S


def _tables(spark, path):
    def write(name, sql):
        spark.sql(sql).write.parquet(f"{path}/{name}.parquet")

    # Keys that repeat (0 to 4), one that is null, and lines of keys without an order.
    write("orders", "select if(id = 47, null, id % 45) o_orderkey, id % 3 o_custkey, 'p' o_orderpriority, 'O' o_orderstatus, date'2020-01-01' o_orderdate from range(50)")
    write("lineitem", "select if(id % 50 = 0, null, id % 60) l_orderkey, cast(id as int) l_linenumber, id % 7 l_partkey, id % 3 l_suppkey, 2.0D l_quantity from range(200)")
    write("part", "select id p_partkey, 'n' p_name, 'b' p_brand, 1 p_size, 1.0D p_retailprice from range(7)")
    write("supplier", "select id s_suppkey, 'n' s_name from range(3)")
    return str(path)


def test_large_documents_come_part_by_part(spark, tmp_path, monkeypatch):  # F3
    d = _tables(spark, tmp_path)
    monkeypatch.setattr(Q, "LARGE_COLLECTIONS", 5, raising=False)
    monkeypatch.setattr(Q, "LARGE_DOCUMENTS", 2, raising=False)
    real, seen = J.read_large_documents, []

    def read(spark, path, *args):
        seen.append((path, [x for x in os.listdir(path.removeprefix("file:")) if x.startswith("slice=")]))
        assert not any(os.path.exists(p.removeprefix("file:")) for p, _ in seen[:-1])
        return real(spark, path, *args)

    monkeypatch.setattr(J, "read_large_documents", read)
    got = Q.json_large_document(spark, d)
    # Each row of a repeated key has all of the key's lines, once for each such row.
    want = N.explode_beside(N.explode_records(S.playlist_dump(spark, d)), "tracks", ["pid"], ["pos", "track_uri", "artist_uri", "duration_ms"])
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    documents = [x for _, own in seen for x in own]
    assert len(seen) == 4 and len(documents) == len(set(documents)) == 10 and max(len(own) for _, own in seen) <= 4
    assert not os.path.exists(seen[-1][0].removeprefix("file:"))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_parts_are_all_documents(spark, tmp_path):
    d = _tables(spark, tmp_path)
    assert S.count_documents(spark, d, 5) == 9
    slices = lambda df: sorted(str(r.info["slice"]) for r in df.select("info").collect())
    parts = [slices(S.playlist_dump(spark, d, 5, (i, 4))) for i in range(4)]
    assert sorted(x for own in parts for x in own) == slices(S.playlist_dump(spark, d, 5)) and all(parts)
