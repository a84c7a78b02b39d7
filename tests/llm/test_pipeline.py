"""The pipeline against brute-force versions of its stages (the network's verdict is taken as given)."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from cadenza.llm import blob_ledger, bpe
from cadenza.session import materialize
from tests.llm import brute
from tests.llm.test_decontamination import brute as leaks

SF = "/root/testdata/sf0.01"


def mask(text):
    spans = sorted((f["start"], f["stop"]) for f in blob_ledger.scan_text(text, blob_ledger.RULES))
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "byte_bpe"]


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = [docs]
    for _, stage in corpus_pipeline.STAGES:
        held.append(materialize(stage(spark, held[-1], SF)))
    rows = [{r["doc_id"]: r.asDict() for r in df.collect()} for df in held]
    assert all(df.columns == columns for df in held[:-1])
    assert 0.8 * len(rows[0]) < len(rows[1]) < len(rows[0])
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(rows[0]) - set(rows[1])
    assert np.mean([marks[i] for i in gone if i in marks]) > 0.9
    text = lambda d: [(i, r["text"]) for i, r in d.items()]
    assert set(rows[2]) == {i for i, (_, _, kept) in brute.near_duplicates(text(rows[1]), 5, 80).items() if kept}
    assert set(rows[3]) == set(rows[2]) - {d for d, _ in leaks(text(rows[2]), bench)}
    assert all(rows[3][i] == rows[0][i] for i in rows[3])
    assert {i: r["text"] for i, r in rows[4].items()} == {i: mask(t) for i, t in text(rows[3])}
    assert all(r["n_chars"] == len(r["text"]) for i, r in rows[4].items() if r["text"] != rows[3][i]["text"])
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")).rank, special_tokens={})
    for i, r in rows[5].items():
        ids = t.encode_ordinary(rows[4][i]["text"])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(rows[4][i]["text"].encode()).hexdigest()
    assert set(rows[5]) == set(rows[4])


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert {r.doc_id for r in docs.collect()} == {r[0] for r in rows}
