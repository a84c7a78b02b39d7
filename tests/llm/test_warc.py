"""WARC archives: round trips, the file format, and DuckDB."""

from __future__ import annotations

import glob
import hashlib
import random

import pytest
import zstandard

from cadenza.llm import warc
from tests.oracle_harness import compare, duck

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
ODD = [
    (1, "http://a", "x" * 99), (2, "http://b", "x" * 99), (3, "http://c", "é" * 50), (9, None, "é" * 50), (4, "a\r\nb c", "é" * 50),
    (5, "u", None), (6, "u", ""), (None, "n", "é" * 50), (None, "n", "q" * 200), (None, "n", "q" * 200), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 40),
    (3, "http://c", "é" * 50), (8, "u", "P*M\x18\x00\x00\x00\x00\x00" * 30), (10, "u", "long " * 400000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", b"y") for r in rows], "page_id bigint, url string, html string, first string, payload binary")


def plainly(rows, least=100):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        h = h or ""
        raw = h.encode()
        again = len(raw) >= least and h in first and i != first[h]
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("archive_bytes", [1, 5000, warc.ARCHIVE_BYTES])
def test_round_trip(spark, tmp_path, archive_bytes):
    warc.write_archives(pages(spark, ODD), f"{tmp_path}/w", archive_bytes=archive_bytes)
    got = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=key) == sorted(plainly(ODD), key=key)
    bodies = sorted((r.payload_digest, bytes(r.payload)) for r in got if r.record_type == "response")
    assert bodies == sorted((d, (h or "").encode()) for (_, _, h), (_, _, d, kind, _) in zip(ODD, plainly(ODD)) if kind == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert {r.url for r in got if r.page_id == 4} == {"a%0D%0Ab%20c"} and {r.url for r in got if r.page_id == 9} == {None}


def test_hot_payload_and_salts(spark, tmp_path):
    rng = random.Random(2)
    ids = rng.sample(range(10**6), 900)
    rows = [(i, f"u{i}", "one payload of many pages " * 10 if k % 3 == 0 else f"page {k} " * 30) for k, i in enumerate(ids)]
    warc.write_archives(pages(spark, rows).repartition(7), f"{tmp_path}/w", archive_bytes=20000)
    got = warc.read_archives(spark, f"{tmp_path}/w", payloads=False)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == sorted(plainly(rows))
    assert got.where("payload is not null").count() == 0


def test_files_are_zstandard_with_a_leading_dictionary(spark, tmp_path):
    rows = [(i, f"http://site/{i}", f"<html><head><title>Page {i}</title></head><body class='main'>{'words and more words ' * (i % 9 + 5)}{i * 7919}</body></html>") for i in range(600)]
    warc.write_archives(pages(spark, rows).coalesce(1), f"{tmp_path}/w", archive_bytes=60000)
    files = [open(f, "rb").read() for f in sorted(glob.glob(f"{tmp_path}/w/part-*"))]
    assert len(files) > 1
    for content in files:
        assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
        assert content.endswith((0x184D2A50).to_bytes(4, "little") + bytes(4))
        dictionary, start = warc.read_dictionary(content)
        assert dictionary.dict_id() != 0
        # Each record is a frame of its own, closed by a checksum.
        whole, rest, frames = [], content[start:], 0
        while rest[:4] == warc.ZSTD_MAGIC:
            assert zstandard.get_frame_parameters(rest).dict_id == dictionary.dict_id() and zstandard.get_frame_parameters(rest).has_checksum
            one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            whole.append(one.decompress(rest))
            rest, frames = one.unused_data, frames + 1
        assert rest == warc.TAIL.encode() and frames == len(list(warc.records(content)))
        assert all(x.startswith(b"WARC/1.1\r\nWARC-Type: ") and x.endswith(b"\r\n\r\n") for x in whole) and b"warcinfo" in whole[0]
        alone = sum(len(zstandard.ZstdCompressor(level=3).compress(x)) for x in whole)
        assert len(content) < alone


def test_broken_archives_are_told(spark):
    tail = warc.TAIL.encode()
    good = warc.archive([warc.page_record(1, "u", b"body", hashlib.sha256(b"body").hexdigest(), None)]) + tail
    assert [f["warc-type"] for f, _ in warc.records(good)] == ["warcinfo", "response"]
    for cut in (1, 9, 20, 60):
        with pytest.raises(ValueError, match="early"):
            list(warc.records(good[:-cut]))
    flipped = bytearray(good)
    flipped[-len(tail) - 6] ^= 0x55
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.records(bytes(flipped)))
    lie = list(warc.records(warc.archive([warc.page_record(1, "u", b"body", "0" * 64, None)]) + tail))[1]
    with pytest.raises(ValueError, match="page 1"):
        warc._page(*lie)


def test_empty_table_and_duckdb(spark, tmp_path):
    warc.write_archives(pages(spark, []), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").count() == 0
    from cadenza.llm.queries import QUERIES

    ok, msg = compare(QUERIES["op11_warc"](spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), warc.SQL)
    assert ok, msg
