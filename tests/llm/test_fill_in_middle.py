"""Fill-in-middle outputs against a plain version and DuckDB."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cadenza.llm import fill_in_middle as fim
from tests.oracle_harness import compare, duck

ODD = [None, "", "a", "<", "<P>", "x <S> y", "a<M", "M>b <", "<P", "S> <<S", "é😀 ab\n\tCD$1 \\ $", "A" * 70000 + " " + "b" * 70000, "\r\n" * 40000 + "end", "x1" * 50000, "$3\\Q[a", "\x00 \x00a"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if n == 0 or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), sha(out), sha(text))


def key(row):
    return tuple((x is not None, x) for x in row)


def test_matches_a_plain_version(spark):
    rows = [(100 * i + k, t) for i, t in enumerate(ODD) for k in range(12)]
    rows += [(None, "a null id"), (-5, "negative id"), (7, "twice"), (7, "twice"), (2**62, "large id")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, form string, output string")
    got = [tuple(r) for r in fim.fim_digests(fim.fill_in_middle(docs)).collect()]
    want = [plainly(i, t) for i, t in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_outputs_give_the_texts_back(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    out = fim.fill_in_middle(docs, rate=100, spm_share=50)
    got = {r.doc_id: (r.form, r.text) for r in out.select("doc_id", "form", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()}
    for i, t in enumerate(ODD):
        assert got[i][1] == (t or "")
        assert (got[i][0] == "plain") == (not t or any(m in t for m in ("<P>", "<S>", "<M>")))


@pytest.mark.parametrize("piece", [1, 2, 7])
def test_counting_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(fim, "PIECE", piece)
    rows = [(i, t) for i, t in enumerate(["", "ab", "ab cd", "a1b2", "12345678", "abcdefgh ijk", " x", "é😀é", "é😀abé😀"])]
    got = {r.doc_id: r.n for r in spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", fim.units(F.col("text")).alias("n")).collect()}
    assert got == {i: len(re.findall("[A-Za-z]+|[^A-Za-z]", t)) for i, t in rows}


def test_empty_table_and_duckdb(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim.fim_digests(fim.fill_in_middle(docs)).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ok, msg = compare(fim.fim_digests(fim.fill_in_middle(docs)), duck("/root/testdata/sf0.001"), fim.SQL)
    assert ok, msg
