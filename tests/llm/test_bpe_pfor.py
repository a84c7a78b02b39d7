"""Byte-level BPE and PFOR token files against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from cadenza.llm import bpe, pfor
from cadenza.llm.common import byte_buffer

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n 's it's 'll''s", "a" * 2000 + "é" * 500, " " * 3000, "日本 ١٢ x²   y", "<|endoftext|> a", "don't", "👍👍 'Re 're"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS).rank, special_tokens={})


def test_slices_and_ids_match_tiktoken(oracle):
    rng = random.Random(7)
    alphabet = [*"ab'strvelmd  \n\t é1２.!,́日ſ ", "'s", "'ll", " '", "'re"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(5000)] + [t or "" for t in ODD]
    ranks = bpe.load_ranks(RANKS)
    ids, rows = bpe.encode_block(*byte_buffer(pa.array(texts)), ranks.encode)
    for i, t in enumerate(texts):
        own = ids[rows[i] : rows[i + 1]].tolist()
        assert own == oracle.encode_ordinary(t), t
        assert ranks.decode(own) == t.encode()


def test_encode_decode_documents(spark, oracle):
    rows = [*enumerate(ODD), (3, "again"), (3, "again")]
    docs = documents(spark, rows)
    got = sorted((r.doc_id, r.ids, r.lengths) for r in bpe.encode_documents(docs, RANKS).collect())
    want = sorted((i, oracle.encode_ordinary(t or "")) for i, t in rows)
    assert [(a, b) for a, b, _ in got] == want
    assert all(sum(n) == len(oracle.decode_bytes(ids)) for _, ids, n in got)
    back = sorted((r.doc_id, r.text) for r in bpe.decode_documents(bpe.encode_documents(docs, RANKS), RANKS).collect())
    assert back == sorted((i, t or "") for i, t in rows)
    digest = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoding_digests(docs, RANKS).collect()}
    assert digest == {(i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (i, t) in rows for x in [oracle.encode_ordinary(t or "")]}


def thue_morse(n, a="a", b="b"):
    word, flip = a, {a: b, b: a}
    while len(word) < n:
        word += "".join(flip[c] for c in word)
    return word, "".join(flip[c] for c in word)


def test_words_that_a_polynomial_hash_confuses(spark, oracle):
    """A word over two letters and its complement: equal hashes under any polynomial modulo 2 ** 64."""
    texts = [*thue_morse(1024), *thue_morse(1024, "e", "t"), *thue_morse(2048), "ab"]
    docs = documents(spark, enumerate(texts)).coalesce(1)
    got = {r.doc_id: r.ids for r in bpe.encode_documents(docs, RANKS).collect()}
    assert got == {i: oracle.encode_ordinary(t) for i, t in enumerate(texts)}
    t = Tokenizer.from_file(JSON)
    read = {r.doc_id: r.ids for r in pfor.read_ids(pfor.token_files(docs, JSON)).collect()}
    assert read == {i: [*t.encode(x).ids, 0] for i, x in enumerate(texts)}


def test_slices_of_equal_hash_are_told_apart(oracle, monkeypatch):
    monkeypatch.setattr(bpe.K, "slice_hashes", lambda data, starts, ends, seed=0: (ends - starts).astype(np.uint64) % np.uint64(2))
    texts = ["one two six ten", "ten six two one", "a bb ccc"]
    ranks = bpe.Ranks(RANKS)
    ids, rows = bpe.encode_block(*byte_buffer(pa.array(texts)), ranks.encode)
    assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])] == [oracle.encode_ordinary(t) for t in texts]


def test_slice_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(8)
    for n in (0, 1, 7, 8, 9, 64, 511, 512, 513, 5000):
        own = rng.integers(0, 256, n).astype(np.uint8)
        room = np.concatenate([rng.integers(0, 256, 13).astype(np.uint8), own, rng.integers(0, 256, 5).astype(np.uint8)])
        one = bpe.K.slice_hashes(room, np.array([13]), np.array([13 + n]))
        assert one == bpe.K.slice_hashes(own, np.array([0]), np.array([n]))
        for i in range(0, n, max(1, n // 9)):
            other = own.copy()
            other[i] ^= 1
            assert one != bpe.K.slice_hashes(other, np.array([0]), np.array([n]))
        assert one != bpe.K.slice_hashes(own, np.array([0]), np.array([n]), seed=1)


def test_empty_table(spark):
    assert bpe.encoding_digests(documents(spark, []), RANKS).count() == 0
    assert pfor.read_digests(pfor.token_files(documents(spark, []), JSON)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_pack_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 40, n).astype(np.uint32)
    ids[rng.random(n) < 0.05] = 2**32 - 1
    payload = pfor.pack_ids(ids)
    assert (pfor.unpack_ids(payload) == ids).all()
    for k in range(-(-n // pfor.BLOCK)):
        assert (pfor.read_block(payload, k) == ids[k * pfor.BLOCK : (k + 1) * pfor.BLOCK]).all()


def test_token_files_match_library(spark):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    rows = [(5 * (len(ODD) - i), x) for i, x in enumerate(ODD)] + [(7, "b"), (7, "a"), (-4, "neg")]
    chunks = pfor.token_files(documents(spark, rows), JSON)
    ids = {}
    start, want = 0, []
    for i, x in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        own = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        ids.setdefault(i, []).append(own)
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(map(tuple, pfor.read_digests(chunks).collect())) == sorted(want)
    assert sorted((r.doc_id, r.ids) for r in pfor.read_ids(chunks).collect()) == sorted((i, x) for i, xs in ids.items() for x in xs)


def test_chunks_split(spark, monkeypatch):
    monkeypatch.setattr(pfor, "CHUNK_IDS", 50)
    rows = [(i, "word " * (i % 7)) for i in range(200)]
    got = {r.doc_id: (r.start, r.n_tokens) for r in pfor.read_digests(pfor.token_files(documents(spark, rows), JSON)).collect()}
    start = 0
    for i in range(200):
        assert got[i][0] == start
        start += got[i][1]


def test_query_matches_added_tokens(spark, tmp_path):
    from cadenza.llm.queries import QUERIES

    t = Tokenizer.from_file(JSON)
    assert t.encode("abc<|endoftext|>def", add_special_tokens=False).ids == [39305, 50256, 4299]
    rows = [*enumerate([*ODD, "abc<|endoftext|>def", "x <|endoftext|> <|endoftext|>", "<|EndOfText|> é", "after it"])]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    start, want = 0, []
    for i, x in rows:
        own = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(map(tuple, QUERIES["op7_token_files"](spark, str(tmp_path)).collect())) == want
