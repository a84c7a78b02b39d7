"""Cross-tokenizer alignment against both libraries and a plain sweep."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cadenza.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", "don't stop", "x\n\n\ty  z ", "日本語のテキスト 👍👍", "naïve café — ", "<|endoftext|> <s></s><unk>", "▁a b", "<0x41> ▁", "é" * 300, "ab" * 3000, "a\x00b",
    "ﬁ ligature ① ½", "́ combining", "ſ ß İ", "   leading and trailing   ", "the the the the", "\r\n" * 50, "1234567890 " * 20,
]


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(libraries, text):
    """Groups of (A ids, B ids) and the linked id pairs, by a sweep over both sides."""
    t, sp = libraries
    shown = alignment.load_sides(A, B).a.shown
    values = {c: b for b, c in shown.items()}
    if not text:
        return [], []
    a = t.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    a_bytes = [bytes(values[c] for c in t.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    raw = (" " + text).encode()
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], []
    span = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[: i + 1]))) for i in range(len(parts))]
    sa, sb = span(a_bytes), span(b_bytes)
    links = [(a[i], b[j]) for i, (s, e) in enumerate(sa) for j, (u, v) in enumerate(sb) if s < v and u < e]
    groups, i, j = [], 0, 0
    for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
        x, y = [], []
        while i < len(a) and sa[i][1] <= cut:
            x.append(a[i])
            i += 1
        while j < len(b) and sb[j][1] <= cut:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    return groups, links


def plainly(libraries, rows):
    both = [(i, *plain_groups(libraries, t)) for i, t in rows]
    count = Counter(p for _, _, links in both for p in set(links))
    top: dict = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for i, groups, links in both:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), sha))
    return out


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, region string, n_a int")


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("region_links", [1, 500, alignment.REGION_LINKS])
def test_odd_texts(spark, libraries, monkeypatch, region_links):
    monkeypatch.setattr(alignment, "REGION_LINKS", region_links)
    rows = [*enumerate(ODD), (5, "don't stop"), (5, "don't stop"), (None, "a null id"), (-3, "the end")]
    got = [tuple(r) for r in alignment.alignment_digests(documents(spark, rows).repartition(3), A, B).collect()]
    want = plainly(libraries, rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] == 0 for r in want) >= 3


def test_groups_of_tokens(spark, libraries):
    rows = [*enumerate(ODD)]
    for r in alignment.align_documents(documents(spark, rows), A, B).collect():
        groups, _ = plain_groups(libraries, ODD[r.doc_id])
        assert (r.a_ids, r.b_ids) == ([i for x, _ in groups for i in x], [i for _, y in groups for i in y])
        assert r.a_groups == [k for k, (x, _) in enumerate(groups) for _ in x]
        assert r.b_groups == [k for k, (_, y) in enumerate(groups) for _ in y]


def test_query_on_a_table(spark, libraries):
    from cadenza.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 4000]
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_alignment"](spark, sf).collect()}
    assert len(got) == len(rows)
    from_short = {r.doc_id: tuple(r) for r in alignment.alignment_digests(documents(spark, short), A, B).collect()}
    for row in plainly(libraries, short):
        assert from_short[row[0]] == row
        assert got[row[0]][:5] == row[:5] and got[row[0]][-1] == row[-1]


def test_label_groups_against_common_ends():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n)) for _ in range(2)]
        common = np.intersect1d(*ends)
        for side, group in zip(ends, alignment.label_groups(*ends)):
            assert (group == np.searchsorted(common, side, "left")).all()


def test_words_of_side_b_against_whole_texts(libraries):
    """But for texts that hold the library's own mark of a space, which have no tokens."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    alphabet = list("ab  \n\t.é日<0x41>'1👍") + ["the", " of", "  "]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(3000)]
    sides = alignment.load_sides(A, B)
    assert sides.by_words
    column = pa.array(texts)
    data, offsets = alignment.byte_buffer(pa.array([" " + t for t in texts]))
    ids, rows = sides.b_tokens(column, data, offsets)
    for t, a, b in zip(texts, rows[:-1], rows[1:]):
        assert not t or ids[a:b].tolist() == libraries[1].encode(t), t


def test_empty_table(spark):
    assert alignment.alignment_digests(documents(spark, []), A, B).count() == 0
    assert alignment.align_documents(documents(spark, []), A, B).count() == 0
