from __future__ import annotations

import random
import re

import pytest

from cadenza.llm import decontamination as de
from tests.llm.brute import lower

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def shingles(ws, n):
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}


def brute(docs, items):
    out = set()
    for d, t in docs:
        have = {n: shingles(words(t), n) for n in (1, 2, 3, 4, 5)}
        for i, text in items:
            own = words(text)
            if own:
                need = shingles(own, min(5, len(own)))
                if len(need & have[min(5, len(own))]) >= 0.8 * len(need):
                    out.add((d, i))
    return out


def documents(spark, rows):
    return spark.createDataFrame([(i, t, i, 0.0) for i, t in rows], "doc_id bigint, text string, item_id bigint, score double")


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, doc_id string")


def test_matches_brute_force_on_a_table(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = de.contaminated(docs, bench)
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    have = lambda df, key: [(r[key], r.text) for r in df.select(key, "text").collect()]
    assert pairs == brute(have(docs, "doc_id"), have(bench, "item_id")) and pairs
    kept = de.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, _ in have(docs, "doc_id")} - {d for d, _ in pairs}


@pytest.mark.parametrize("index_bytes", [de.INDEX_BYTES, 4000])
def test_places_lengths_and_odd_rows(spark, index_bytes):
    rng = random.Random(1)
    word = lambda: "w" + str(int(rng.paretovariate(0.4)) % 5000)
    bench = [(i, " ".join(word() for _ in range(rng.choice([6, 15, 40, 60, 200]))) + ". " + " ".join(word() for _ in range(6)) + ".") for i in range(60)]
    bench += [(900, ""), (901, None), (902, "two words"), (903, "..."), (0, bench[0][1])]
    docs = []
    for i in range(150):
        filler = [word() for _ in range(rng.randint(0, 150))]
        k = rng.randint(0, len(filler))
        own = bench[i % 60][1].upper() if i % 3 == 0 else bench[i % 60][1]
        if i % 5 == 4:  # half of an item is no match
            own = " ".join(own.split()[: len(own.split()) // 2])
        docs.append((i, " ".join([*filler[:k], own, *filler[k:]])))
    docs += [(500, None), (501, ""), (502, "say two, words"), (503, "two and words"), (504, bench[7][1]), (504, bench[7][1]), (505, "filler " * 30000 + bench[8][1])]
    got = de.contaminated(documents(spark, docs), items(spark, bench), index_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, bench)
    assert len([r for r in got if r.doc_id == 504 and r.item_id == 7]) == 2
    assert all(0 <= x <= 1 for r in got for x in r[2:])


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, "a b c d e f")]), items(spark, [(1, "a b c d e f")])
    assert de.contaminated(documents(spark, []), bench).count() == 0
    assert de.contaminated(docs, items(spark, [])).count() == 0
    assert de.decontaminate(docs, items(spark, [])).count() == 1
    assert de.decontaminate(docs, bench).count() == 0


def test_edits_in_and_before_a_short_last_sentence(spark):
    question = "which of the rivers named below flows north through the old capital before it meets the sea near the harbour town"
    bench = [(1, question + ". Elbe."), (2, question.replace("rivers", "roads") + "? It is 3.5"), (3, question.replace("rivers", "hills"))]
    docs = []
    for i, text in bench:
        own = text.split()
        docs += [(10 * i, " ".join([*own[:-1], "changed"])), (10 * i + 1, " ".join([*own[:-2], "changed", own[-1]])), (10 * i + 2, " ".join(own[:-1])), (10 * i + 3, " ".join(own[: len(own) // 2]))]
    got = {(r.doc_id, r.item_id) for r in de.contaminated(documents(spark, docs), items(spark, bench)).collect()}
    assert got == brute(docs, bench) and {(10, 1), (11, 1), (12, 1), (20, 2), (30, 3)} <= got
    kept = {r.doc_id for r in de.decontaminate(documents(spark, docs), items(spark, bench)).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


@pytest.mark.parametrize("length,parts", [(48, 3), (48, 2), (100, 5), (60, 4), (200, 9)])
def test_items_in_parts(spark, length, parts):
    """An item whose parts stand far from one another, in any order, matches if 80 percent of its shingles stand there."""
    rng = random.Random(length + parts)
    word = lambda: "w" + str(int(rng.paretovariate(0.4)) % 3000)
    bench = [(i, " ".join(word() for _ in range(length))) for i in range(20)]
    docs = []
    for i, text in bench:
        own = text.split()
        cuts = [length * k // parts for k in range(parts + 1)]
        pieces = [own[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        rng.shuffle(pieces)
        docs.append((i, " ".join(" ".join([*p, *[word() for _ in range(100)]]) for p in pieces)))
        docs.append((100 + i, " ".join(" ".join([*p[:-3], *[word() for _ in range(100)]]) for p in pieces)))
    got = de.contaminated(documents(spark, docs), items(spark, bench)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, bench)
    assert all(0 < r.score <= 1 for r in got)
    if 5 * 4 * (parts - 1) <= length - 4:
        assert {(i, i) for i, _ in bench} <= {(r.doc_id, r.item_id) for r in got}


def test_most_absent_against_all_choices():
    """No choice of absent words that leaves enough shingles weighs more than the bound."""
    from itertools import combinations

    rng = random.Random(9)
    for n in (5, 6, 7, 9, 11):
        for repeated in (False, True):
            for _ in range(12):
                words = [rng.randrange(n // 2 + 1) if repeated else i for i in range(n)]
                weight = {w: rng.random() for w in words}
                first = [weight[w] if w not in words[:i] else 0.0 for i, w in enumerate(words)]
                own = [tuple(words[i : i + 5]) for i in range(n - 4)]
                for missing in range(len(set(own))):
                    best = 0.0
                    for k in range(len(weight) + 1):
                        for gone in combinations(weight, k):
                            if sum(bool(set(s) & set(gone)) for s in set(own)) <= missing:
                                best = max(best, sum(weight[w] for w in gone))
                    bound = de.most_absent(de.np.array(first), missing, len(set(own)) == len(own))
                    assert bound >= best - 1e-9
                    if not repeated:
                        assert abs(bound - best) < 1e-9
