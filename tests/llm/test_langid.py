from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from cadenza.llm import langid
from cadenza.llm.common import labelled_sample

SF = "/root/testdata/sf0.01"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s") for i, t, lang in rows], "doc_id bigint, text string, lang string, held_out string")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict_languages(docs).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    own = got[got.held_out & (got.lang_pred != "und")]
    assert np.mean([truth[i] == p for i, p in zip(own.doc_id, own.lang_pred)]) > 0.97


def test_one_language_and_unknown_codes(spark):
    rows = [(i, "only words here" if i % 2 else "xyz qqq zzz www", "en" if i % 2 else "tlh") for i in range(40)]
    got = {r.doc_id: r.lang_pred for r in langid.predict_languages(documents(spark, rows)).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    one = langid.predict_languages(documents(spark, [(i, "some words", "en") for i in range(20)])).collect()
    assert {r.lang_pred for r in one} == {"en"}


def test_odd_rows(spark):
    rows = [(i, "the words of a text" if i % 2 else "das sind die wörter", "en" if i % 2 else "de") for i in range(40)]
    odd = [(100, None, "en"), (101, "", None), (102, " 12 %% \n", "en"), (103, "é", "de"), (104, "the words " * 20000, None), (104, "the words " * 20000, None), (None, "the words", "en")]
    got = langid.predict_languages(documents(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[103].lang_pred in ("de", "en")
    assert by[104].lang_pred == "en" and by[None].held_out is False
    assert langid.predict_languages(documents(spark, [])).count() == 0
    assert {r.lang_pred for r in langid.predict_languages(documents(spark, [(1, "words", None)])).collect()} == {"und"}


def test_learns_only_from_its_fold(spark):
    rows = [(i, "the words" if i % 2 else "die wörter", "en" if i % 2 else "de") for i in range(200)]
    docs = documents(spark, rows)
    chosen = labelled_sample(docs, docs.select("doc_id", F.col("lang").alias("label")), 10)
    assert sorted(lang for _, lang in chosen) == ["de"] * 10 + ["en"] * 10
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert "xx" not in {r.lang_pred for r in langid.predict_languages(documents(spark, wrong)).collect()}


def test_sample_takes_label_and_text_of_one_row(spark):
    from pyspark.sql import functions as F

    from cadenza.llm.common import labelled_sample

    rows = [(1, "b text", "en"), (1, "a text", "fr"), (2, "x", "en"), (3, None, "en"), (4, "y", None), (None, "z", "en"), (5, "w", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labelled = docs.select("doc_id", F.col("lang").alias("label"))
    assert labelled_sample(docs, labelled, 10, F.col("lang")) == [("b text", "en"), ("x", "en"), ("w", "fr")]
    many = spark.range(5000).selectExpr("id AS doc_id", "concat('t', id) AS text", "if(id % 3 = 0, 'a', 'b') AS lang")
    found = labelled_sample(many, many.select("doc_id", F.col("lang").alias("label")), 700, F.col("lang"))
    assert sorted({label: sum(x == label for _, x in found) for label in "ab"}.values()) == [700, 700]
    again = labelled_sample(many.repartition(13), many.select("doc_id", F.col("lang").alias("label")), 700, F.col("lang"))
    assert found == again
