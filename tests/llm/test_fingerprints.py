from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cadenza.llm import fingerprints as fp
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "b", "g") for i, t in rows], "doc_id bigint, text string, bucket string, `group` string")


def sketch(text, k=fp.K):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    out = {hashlib.md5(" ".join(words[i : i + 5]).encode()).hexdigest()[:16] for i in range(max(1, len(words) - 4))} if words else set()
    return sorted(out)[:k]


def near(a, b, k=fp.K):
    union = sorted({*a, *b})[:k]
    return len({*a} & {*b} & {*union}) / len(union) if union else 1.0


def test_matches_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ok, message = compare(fp.fingerprints(docs), duck(SF), fp.SQL)
    assert ok, message


def test_matches_brute_force_on_sparse_ids(spark):
    rng = random.Random(2)
    words = [f"wörd{i}" for i in range(30)]
    rows = [(rng.randint(-(10**7), 10**7), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 5, 9, 300])))) for _ in range(120)]
    rows += [(3, None), (4, ""), (5, "a b"), (6, "a b"), (7, "x " * 5000), (None, "null id"), (8, "\t\n é")]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    got = {r.doc_id: r for r in fp.fingerprints(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(n + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == ",".join(sketch(t)) and r.edited_fingerprint == ",".join(sketch(edited))
        assert r.near_edited == pytest.approx(near(sketch(t), sketch(edited)))
        assert r.near_next == pytest.approx(near(sketch(t), sketch(after)))


def test_repeated_rows_and_empty_table(spark):
    got = fp.fingerprints(documents(spark, [(1, "a"), (1, "a"), (1, None)])).collect()
    assert len(got) == 3
    assert fp.fingerprints(documents(spark, [])).count() == 0


def test_merge_and_estimates(spark):
    rng = random.Random(4)
    a = [f"a{rng.randint(0, 10**6)}" for _ in range(4000)]
    whole = " ".join(a)
    parts = [" ".join(a[max(0, i - 4) : i + 500]) for i in range(0, 4000, 500)]
    rows = [(i, p) for i, p in enumerate(parts)] + [(99, "")]
    df = fp.with_sketch(documents(spark, rows).withColumn("g", F.when(F.col("doc_id") < 99, 1).otherwise(2)), "text", "sketch")
    got = {r.g: list(r.sketch) for r in fp.merge_sketches(df, "g", "sketch").collect()}
    assert got == {1: sketch(whole), 2: []}
    two = documents(spark, [(1, whole)]).select(F.col("text").alias("x"), F.lit(" ".join(a[:1000])).alias("y"))
    two = fp.with_sketch(fp.with_sketch(two, "x", "sx"), "y", "sy")
    r = two.select(fp.resemblance(F.col("sx"), F.col("sy")).alias("j"), fp.containment(F.col("sy"), F.col("sx")).alias("c"), fp.distinct_shingles(F.col("sx")).alias("n")).first()
    assert abs(r.j - 996 / 3996) < 0.15 and r.c > 0.6 and abs(r.n / 3996 - 1) < 0.35
