from __future__ import annotations

import zlib

import numpy as np

from cadenza.llm import kernels as K
from cadenza.llm import toxicity as tx
from cadenza.llm.common import byte_buffer

SF = "/root/testdata/sf0.01"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 9) for i, t in rows], "doc_id bigint, text string, score double, label int")


def labels(spark, rows):
    return spark.createDataFrame([(i, y, "x") for i, y in rows], "doc_id bigint, toxic int, text string")


def test_held_out_accuracy(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.score(docs, tx.fit(docs, marks)).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    truth = {r.doc_id: r.toxic for r in marks.collect()}
    own = got[got.held_out & got.doc_id.isin(truth)]
    y, s = np.array([truth[i] for i in own.doc_id]), own.score.to_numpy()
    # A few dozen positive texts are all there is to learn from here.
    assert (s[y == 1][:, None] > s[y == 0]).mean() > 0.9
    assert (s[y == 0] >= 0.7).mean() < 0.02 and (s[y == 1] >= 0.7).mean() > 0.6


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = tx.Network.new()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(0, 1, (12, tx.INPUTS))
    index, mask = rng.integers(0, 12, (tx.WINDOW, 3)), (np.arange(tx.WINDOW)[:, None] < np.array([32, 5, 1])).astype(float)

    def loss():
        return float(np.tanh(net.forward(net.project(x), index, mask)[0]).sum())

    logits, held = net.forward(net.project(x), index, mask, keep=True)
    grads, d_x = net.backward(held, mask, 1 - np.tanh(logits) ** 2)
    for d in "fb":
        grads[f"x{d}"] = np.einsum("tni,tnj->ij", x[index], d_x[d])
    for name in ("out", "bias", "attend", "attend_bias", "attend_out", "hf", "hb", "xf", "xb", "cf", "cb"):
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        old, step = net.p[name][at], 1e-2
        net.p[name][at] = old + step
        high = loss()
        net.p[name][at] = old - step
        low = loss()
        net.p[name][at] = old
        assert np.isclose((high - low) / (2 * step), grads[name][at], rtol=0.05, atol=2e-3), name


def test_windows_cover_and_overlap():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        first, length, text = tx.windows(np.array([0, n]))
        seen = np.zeros(n, int)
        for a, b in zip(first, length):
            seen[a : a + b] += 1
        assert (seen > 0).all() and (not n or first[-1] + length[-1] == n)
        assert all(b - a <= tx.STRIDE for a, b in zip(first, first[1:]))


def test_words_have_their_grams():
    words = tx.Words.of(*byte_buffer(__import__("pyarrow").array(["ab abc ab", "", "x"])))
    assert words.rows.tolist() == [0, 3, 3, 4] and len(words.lengths) == 3
    assert sorted(zip(words.lengths.tolist(), np.diff(words.gram_at).tolist())) == [(1, 1), (2, 3), (3, 6)]
    assert K.ranges(np.array([5, 1]), np.array([2, 1])).tolist() == [5, 6, 1]


def test_odd_rows_and_labels(spark):
    rows = [(i, ("you vile " if i % 2 else "you kind ") + f"w{i} " * (i % 20)) for i in range(120)]
    rows += [(i, f"n{i} calm {'y' * i} " * (i % 9 + 1)) for i in range(300, 360)]  # neither, and not toxic
    marks = [(i, i % 2) for i in range(110)] + [(i, 0) for i in range(300, 360)] + [(1, 1), (5, None), (None, 1), (9999, 1)]
    odd = [(200, None), (201, ""), (202, " .. "), (203, "plain " * 30000 + "so vile " + "plain " * 20), (203, "plain"), (None, "you vile"), (204, "x" * 100000)]
    got = tx.score(documents(spark, rows + odd), tx.fit(documents(spark, rows + odd), labels(spark, marks))).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == i % 2 for i in range(120))
    assert by[200].score == by[201].score == by[202].score and 0 < by[200].score < 0.7
    assert max(r.score for r in got if r.doc_id == 203) > 0.5 and by[None].held_out is False and by[None].predicted == 1
    clean = tx.reject(documents(spark, rows + odd), tx.fit(documents(spark, rows + odd), labels(spark, marks)))
    assert clean.columns == ["doc_id", "text", "score", "label"]
    assert {r.doc_id for r in clean.collect()} >= {i for i in range(0, 120, 2)} | {200, 201, 202}


def test_no_labels_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    assert {r.score for r in tx.score(docs, tx.fit(docs, labels(spark, []))).collect()} == {0.0}
    assert {r.score for r in tx.score(docs, tx.fit(docs, labels(spark, [(1, 1), (2, 1)]))).collect()} <= {0.0, 1.0}
    none = documents(spark, [])
    assert tx.score(none, tx.fit(none, labels(spark, [(1, 1)]))).count() == 0
