from __future__ import annotations

import random
import re

from cadenza.llm import licenses as li
from tests.llm.brute import lower

MIT = li.TEMPLATES[10][1]
ODD = [
    None, "", "CC BY cc-by General Public License! ALL rights\nreserved all rights reserved", "Ünder cc by", "cc", "all rights", "reserved",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    MIT.upper() + ".", " ".join(MIT.split()[:20]) + " zzz " + " ".join(MIT.split()[21:]), "the of the to the in the " * 4000, "x " * 50000 + "all rights reserved",
]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "l", 0.5) for i, t in rows], "doc_id bigint, text string, labels string, score double")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places, labels = [], set()
    for phrase, label in li.PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force(spark):
    rng = random.Random(3)
    pieces = ["cc", "by", "BY", "general", "public", "License", "all", "rights", "reserved", "é", "a1", "-", "\n"]
    rows = [*enumerate(ODD), *((100 + i, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))) for i in range(400)), (2, ODD[2]), (None, "cc by")]
    got = li.scan_licenses(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got}
    assert by == {i: brute(t) for i, t in rows}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert li.scan_licenses(documents(spark, [])).count() == 0


def test_template_labels(spark):
    got = {r.doc_id: r for r in li.scan_licenses(documents(spark, [*enumerate(ODD)])).collect()}
    assert [got[i].labels for i in (7, 8, 9, 10, 11, 12)] == ["mit", "apache-2.0", "gpl", "mit", "mit", ""]
    assert got[10].score == 1.0 and 0.9 < got[11].score < 1.0
    span = got[10].spans[0]
    assert (span.first, span.stop, span.coverage) == (0, len(MIT.split()), 1.0)


def test_matching_statistics_match_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        templates = [[rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(4)]
        a = li.Automaton()
        for t in templates:
            a.add(t)
        for i, t in enumerate(templates):
            a.place(i, t)
        text = [rng.randrange(5) for _ in range(40)]
        for i, (state, n) in enumerate(a.statistics(text)):
            inside = lambda s, t: any(t[k : k + len(s)] == s for k in range(len(t) - len(s) + 1))
            best = max(k for k in range(i + 2) if k == 0 or any(inside(text[i + 1 - k : i + 1], t) for t in templates))
            assert n == best
            if n:
                own = text[i + 1 - n : i + 1]
                assert set(a.ends[state]) == {j for j, t in enumerate(templates) if inside(own, t)}
                assert all(templates[j][e - n : e] == own for j, e in a.ends[state].items())


def test_every_notice_of_a_text_has_its_span(spark):
    words = MIT.split()
    text = " ".join([*words, "filler " * 40, *words, "other " * 3, *words])
    got = li.scan_licenses(documents(spark, [(1, text)])).first()
    n, a = len(words), [0, len(words) + 40, 2 * len(words) + 43]
    assert sorted((s.first, s.stop) for s in got.spans if s.label == "mit") == [(i, i + n) for i in a]
    assert all(s.coverage == 1.0 for s in got.spans if s.label == "mit") and got.score == 1.0
    for label in {s.label for s in got.spans}:
        own = sorted((s.first, s.stop) for s in got.spans if s.label == label)
        assert all(x[1] <= y[0] for x, y in zip(own, own[1:]))
