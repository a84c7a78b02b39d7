from __future__ import annotations

import random

import pytest

from cadenza.llm import components, lsh_forest
from cadenza.llm.components import connected_components
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, set_key string")


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("held", [1 << 20, 40])
def test_components(spark, monkeypatch, held):
    monkeypatch.setattr(components, "LOCAL_EDGES", held)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(60)] + [(5, 5), (None, 4), (100, 101)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: find(i) for i in parent}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("size", [4, 5])
def test_matches_brute_force_on_a_table(spark, size):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(lsh_forest.near_duplicates(docs, size, 80)) == brute.near_duplicates(rows, size, 80)


@pytest.mark.parametrize("block,shingles", [(1024, 1 << 22), (9, 1 << 22), (40, 900)])
def test_large_groups_and_odd_rows(spark, monkeypatch, block, shingles):
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    monkeypatch.setattr(lsh_forest, "SHINGLES", shingles)
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    rows = []
    for i in range(150):  # one large group of near copies, more than a region holds
        words = list(base)
        words[rng.randrange(120)] = f"z{i}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(f"q{i}_{j // 2}" for j in range(30))) for i in range(20)]
    rows += [(300, None), (301, ""), (302, " \t "), (303, "One two"), (304, "one TWO"), (305, "one two three"), (306, "É a b c"), (307, "é a b c")]
    rows += [(400 + i, " ".join(base[: 60 + 3 * i])) for i in range(20)]  # a chain
    got = lsh_forest.near_duplicates(documents(spark, rows + [(303, "One two"), (None, "one two")]), 4, 80).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == brute.near_duplicates(rows, 4, 80)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = sorted(r.doc_id for r in lsh_forest.deduplicate(documents(spark, rows + [(303, "One two")]), 4, 80).collect())
    assert kept == sorted(i for i, (_, _, k) in brute.near_duplicates(rows, 4, 80).items() if k)


def test_empty_table(spark):
    assert lsh_forest.near_duplicates(documents(spark, [])).count() == 0


def edited(rng, words, n, mark):
    """``words`` with n of them changed, far from one another."""
    out = list(words)
    for k in rng.sample(range(0, len(words) - 4, 5), n):
        out[k + 2] = f"{mark}_{k}"
    return " ".join(out)


@pytest.mark.parametrize("n", [300, 2000])
def test_copies_around_an_original_of_middle_id(spark, n):
    """The links lead to the original only (about 0.82; between copies about 0.67)."""
    rng = random.Random(n)
    base = [f"w{i}" for i in range(203)]
    texts = [edited(rng, base, 5, f"z{i}") for i in range(n)]
    texts.insert(n // 2, " ".join(base))
    assert brute.near_duplicates([(0, " ".join(base)), (1, texts[0])], 4, 80)[1][1] == 0
    got = result(lsh_forest.near_duplicates(documents(spark, list(enumerate(texts))), 4, 80))
    assert {c for _, c, _ in got.values()} == {0} and len(got) == n + 1


def test_links_inside_large_runs_without_a_center(spark, monkeypatch):
    """Texts of one frame (about 0.67 alike) stay in large runs; each has one partner of about 0.82."""
    monkeypatch.setattr(lsh_forest, "BLOCK", 20)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(203)]
    rows = []
    for i in range(120):
        own = edited(rng, base, 5, f"z{i}").split(" ")
        rows += [(2 * i, " ".join(own)), (2 * i + 1, edited(rng, own, 5, f"y{i}"))]
    rng.shuffle(rows)
    rows = [(7 * k, t) for k, (_, t) in enumerate(rows)]
    assert result(lsh_forest.near_duplicates(documents(spark, rows), 4, 80)) == brute.near_duplicates(rows, 4, 80)


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += "".join({"a": "b", "b": "a"}[c] for c in word)
    return word, "".join({"a": "b", "b": "a"}[c] for c in word)


def test_texts_that_a_polynomial_hash_confuses(spark):
    rows = list(enumerate([*thue_morse(1024), "x y z " + thue_morse(1024)[0], "x y z " + thue_morse(1024)[1], thue_morse(1024)[0]]))
    assert result(lsh_forest.near_duplicates(documents(spark, rows), 4, 80)) == brute.near_duplicates(rows, 4, 80)


def test_a_family_without_links_writes_no_pairs(spark, monkeypatch):
    """Texts of one frame, about 0.69 alike: all are one family, none is linked."""
    monkeypatch.setattr(lsh_forest, "BLOCK", 64)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(240)]
    rows = [(i, edited(rng, base, 5, f"z{i}")) for i in range(200)]
    docs = documents(spark, rows)
    found = []
    held = lsh_forest.materialize
    monkeypatch.setattr(lsh_forest, "materialize", lambda df: found.append(out := held(df)) or out)
    counts = []
    monkeypatch.setattr(lsh_forest, "release", lambda *tables: counts.extend(t.count() for t in tables if t is not None))
    got = result(lsh_forest.near_duplicates(docs, 4, 80))
    assert got == brute.near_duplicates(rows, 4, 80)
    assert len({c for _, c, _ in got.values()}) > 150
    assert max(counts) <= 16 * len(rows)


def test_deduplicate_keeps_clashing_columns(spark):
    rows = [(1, "one two three four five six", "a", 1), (2, "one two three four five six", "b", 2), (3, "else", "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept_id string, _kept_id int")
    assert sorted(map(tuple, lsh_forest.deduplicate(docs).collect())) == [rows[0], rows[2]]
