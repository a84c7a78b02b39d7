from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np

from cadenza.llm import pii

ODD = [
    None, "", "a.b@c.d@e.f x@y z@q..r", "1.2.3.4.5.6.7.8.9 256.1.1.1 01.002.3.4", "4111 1111-1111 1111, 4111111111111112 41111111111111111111",
    "+1 (499) 555-6503%%% +49 30 12345678901234 +1 5 + 1 23", "x" * 60000 + "@" + "é", "1" * 60000, "9 " * 3000 + "+4 4 4 4 4 4 4 4 4",
    "reach jane (at) mail (dot) example.com or call (499) 555-6503 or phone: 499 555 6503", "٣٣٣@x.y", "a@b.c" * 50,
]


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "s", "b") for i, t in rows], "doc_id bigint, text string, spans string, base string")


def test_base_matches_patterns():
    rng = random.Random(9)
    pieces = [*"0123456789. -()+@%", "4111111111111111", "192.168.0.1", "a.b", "@x.y", " é", "255", "5500 0000 0000 0004", "+1 (555) 555-0100"]
    for n in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute(text), text
    for text in ODD:
        if len(text or "") < 20000:
            assert pii.base_spans(text or "") == brute(text)


def test_digests_and_added_spans(spark):
    rows = [*enumerate(ODD), (9, ODD[9]), (None, "x@y.z")]
    got = pii.span_digests(pii.find_personal_data(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        if len(t or "") < 20000:
            spans = brute(t)
            assert by[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
            assert [by[i].n_email, by[i].n_ip, by[i].n_card, by[i].n_phone] == [sum(k == x for k, _, _ in spans) for x in pii.KINDS]
            assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(by[i].spans.split(",")) | {""}
    text = ODD[9]
    added = [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in by[9].spans.split(","))]
    assert added == ["jane (at) mail (dot) example.com", "(499) 555-6503", "499 555 6503"]
    assert pii.find_personal_data(documents(spark, [])).count() == 0


def test_dynamic_programs_match_enumeration():
    text = "call +1 499 555 6503 12 then 10.0.0.1 and 4111 1111 1111 1111"
    lattice = pii.Lattice(text, pii.base_matches(text))
    keep = np.random.default_rng(1).permutation(len(lattice.spans))[:10]
    lattice.spans = [lattice.spans[i] for i in sorted(keep)]
    ends, starts = np.array([s[2] for s in lattice.spans]), np.array([s[1] for s in lattice.spans])
    lattice.before = np.searchsorted(ends, starts, "right").tolist()
    s = np.random.default_rng(2).normal(0, 2, 10)
    total, each, best = 0.0, np.zeros(10), (-1.0, ())
    for k in range(11):
        for own in itertools.combinations(range(10), k):
            if all(ends[a] <= starts[b] or ends[b] <= starts[a] for a, b in itertools.combinations(own, 2)):
                p = np.exp(s[list(own)].sum())
                total += p
                each[list(own)] += p
                best = max(best, (s[list(own)].sum(), own))
    assert np.allclose(lattice.marginals(s), each / total)
    assert lattice.best(s) == [lattice.spans[i] for i in best[1]]


def test_training_moves_to_labels():
    texts = [f"at 10.0.0.{i} or 300.1.1.{i} and 4111 1111 1111 1111 x +1 (499) 555-65{i:02d}" for i in range(30)]
    w = pii.fit(texts)
    likelihood = lambda v: sum(np.log(np.clip(x.marginals(x.scores(v))[x.label == 1], 1e-12, 1)).sum() for x in (pii.Lattice(t, pii.base_matches(t)) for t in texts))
    assert likelihood(w) > likelihood(pii.prior())
    assert all(set(pii.base_spans(t)) == set(pii.all_spans(t, w)) for t in texts)


def test_long_phone_matches_and_any_case():
    for text in ["+1" + fill * 5000 + "2345678" for fill in " .-"] + ["+1" + " " * 5000 + "2345678" * 3, "+1" + " " * 4094 + "234567"]:
        assert pii.base_spans(text) == brute(text), text[:4]
    assert pii.base_spans("+1" + " " * 5000 + "2345678") == [("phone", 0, 5009)]
    for at in ("(at)", "(At)", "(aT)", "[AT]", "[At]"):
        assert pii.all_spans(f"joe {at} example.org", pii.prior()) == [("email", 0, 20)]
