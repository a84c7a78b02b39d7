"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs of a word: evidence of the word itself, the largest and the mean
evidence of its character n-grams, its length, and the mean of learned
embeddings of its character trigrams. Evidence is the shrunken log-odds of
the label among the training texts that hold the word or n-gram; for a
training text itself its own count is left out, so it can't give itself away.

A gated recurrent unit reads each window of ``WINDOW`` words in both
directions; attention pools its states into one logit. All windows of the
whole text are scored, ``STRIDE`` words apart, each overlapping the next, and
the text's score is that of its highest window. Training (numpy: back-propagation
through time, Adam) takes from each text the window that scores highest so
far, so negatives are their hardest windows; it begins with some of the texts
and adds those of the rest that it scores worst.

The network is trained on the driver on at most ``PER_LABEL`` labelled texts
of each label; its size doesn't depend on the data.

Defined results: a text without words (null, empty) has the label's share in
the training rows as its score, as all texts have when only one label or none
was seen (0 without labels); labels that are null teach nothing, of a repeated
doc_id the smallest counts; a null doc_id is never held out; repeated rows
each get their row; an empty table gives an empty result; other columns are
dropped (or kept, by ``reject``).
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import kernels as K
from cadenza.llm.common import byte_buffer, filter_blocks, map_blocks, remainder, sample_rows, ship, texts

#: Labelled texts of each label that the network is trained on.
PER_LABEL = 1600
#: Of these, texts of each label that training begins with, and those it adds at each of two looks at the rest: the worst scored.
BEGIN, ADD = 600, 150
WINDOW, STRIDE = 32, 16
HIDDEN, EMBEDDED, ATTENTION = 8, 4, 8
#: Hashed places of words, character n-grams and learned trigrams.
WORD_BITS, CHAR_BITS, TRIGRAM_BITS = 18, 18, 11
#: Strength of the prior in evidence, in texts.
SHRINK = 2.0
#: Texts of a batch; passes and updates at least.
BATCH, EPOCHS, UPDATES, RATE, DECAY = 48, 8, 300, 0.02, 1e-3
#: Training shrinks each input evidence by up to this share at random.
NOISE = 0.3
PREDICT = 0.7
FIXED_INPUTS = 4
INPUTS = FIXED_INPUTS + EMBEDDED


@dataclass
class Words:
    """The distinct words of a block of texts, the distinct index of each word, and the texts' n + 1 offsets."""

    which: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    lengths: np.ndarray
    #: Places of each distinct word's character n-grams (3 to 5 bytes, with word ends), end to end, with offsets.
    grams: np.ndarray
    gram_at: np.ndarray
    trigrams: np.ndarray
    trigram_at: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        low = K.LOWER[data]
        starts, ends, rows = K.word_spans(low, offsets, K.ALNUM)
        hashes, first, which = np.unique(K.slice_hashes(low, starts, ends), return_index=True, return_inverse=True)
        lengths = (ends - starts)[first]
        # The distinct words between two marks each, end to end.
        wide = lengths + 2
        at = np.cumsum(wide) - wide
        marked = np.full(int(wide.sum()), 1, np.uint32)
        marked[K.ranges(at + 1, lengths)] = low[K.ranges(starts[first], lengths)]
        grams, trigrams, trigram_at = [], np.zeros(0, np.int16), np.zeros(len(first) + 1, np.int64)
        counts = np.zeros(len(first), np.int64)
        h = np.zeros(len(marked), np.uint32)
        for size in (1, 2, 3, 4, 5):
            h[: len(h) - size + 1] = (h[: len(h) - size + 1] ^ marked[size - 1 :]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
            if size >= 3:
                n = np.maximum(wide - size + 1, 0)
                places = K.ranges(at, n)
                mixed = h[places] * np.uint32(0xC2B2AE35)
                grams.append((np.repeat(np.arange(len(first)), n), mixed >> np.uint32(32 - CHAR_BITS)))
                counts += n
                if size == 3:
                    trigrams, trigram_at = (mixed >> np.uint32(32 - TRIGRAM_BITS)).astype(np.int16), np.append(0, np.cumsum(n))
        word = np.concatenate([g[0] for g in grams])
        order = np.argsort(word, kind="stable")
        return cls(which.astype(np.int32), rows, hashes, lengths, np.concatenate([g[1] for g in grams])[order].astype(np.int32), np.append(0, np.cumsum(counts)), trigrams, trigram_at)

    @property
    def places(self) -> np.ndarray:
        return (self.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and text of every window: ``STRIDE`` apart, the last one reaching the text's end."""
    n = np.diff(rows)
    count = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, (n > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), count)
    first = K.ranges(np.zeros(len(n), np.int64), count) * STRIDE
    first = np.minimum(first, np.maximum(n[text] - WINDOW, 0))
    return rows[:-1][text] + first, np.minimum(n[text], WINDOW), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Parameters; ``forward`` keeps what ``backward`` needs."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        p = {"trigrams": rng.normal(0, 0.1, (1 << TRIGRAM_BITS, EMBEDDED))}
        for d in "fb":
            p |= {f"x{d}": draw(INPUTS, 3 * HIDDEN), f"h{d}": draw(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN)}
        p |= {"attend": draw(2 * HIDDEN, ATTENTION), "attend_bias": np.zeros(ATTENTION), "attend_out": draw(ATTENTION, 1)[:, 0], "out": draw(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1)}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def inputs(self, words: Words, fixed: np.ndarray) -> np.ndarray:
        """Inputs of the distinct words: fixed ones, then the mean trigram embedding."""
        out = np.zeros((len(fixed), INPUTS), np.float32)
        out[:, :FIXED_INPUTS] = fixed
        if len(fixed):
            n = np.diff(words.trigram_at)
            out[:, FIXED_INPUTS:] = np.add.reduceat(self.p["trigrams"][words.trigrams], words.trigram_at[:-1], axis=0) / n[:, None]
        return out

    def forward(self, projected: dict[str, np.ndarray], index: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows: ``index`` (steps, windows) into rows of the projected inputs, ``mask`` where a word stands."""
        p, (steps, n) = self.p, index.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        kept: dict = {"f": [], "b": []}
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), np.float32)
            own = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            for t in order:
                x, u = projected[d][index[t]], h @ p[f"h{d}"]
                gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                m = mask[t][:, None]
                new = h + m * (1 - z) * (c - h)
                if keep:
                    kept[d].append((t, h, z, r, c, u[:, 2 * HIDDEN :]))
                h = new
                states[t, :, own] = h
        seen = np.tanh(states @ p["attend"] + p["attend_bias"])
        e = np.where(mask > 0, seen @ p["attend_out"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        logits = pooled @ p["out"] + p["bias"][0]
        return logits, {"states": states, "seen": seen, "a": a, "pooled": pooled, "kept": kept}

    def backward(self, held: dict, mask: np.ndarray, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        """Gradients of the parameters above the inputs, and of the projected inputs (steps, windows, 3 HIDDEN)."""
        p = self.p
        states, seen, a, pooled = held["states"], held["seen"], held["a"], held["pooled"]
        g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = a[:, :, None] * d_pooled
        d_a = np.einsum("tnh,nh->tn", states, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        g["attend_out"] = np.einsum("tn,tna->a", d_e, seen)
        d_seen = d_e[:, :, None] * p["attend_out"] * (1 - seen * seen)
        g["attend"] = np.einsum("tnh,tna->ha", states, d_seen)
        g["attend_bias"] = d_seen.sum(axis=(0, 1))
        d_states = d_states + d_seen @ p["attend"].T
        d_x = {}
        for d in "fb":
            own = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            d_x[d] = np.zeros((*mask.shape, 3 * HIDDEN), np.float32)
            g[f"h{d}"] = np.zeros_like(p[f"h{d}"])
            d_h = np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t, h, z, r, c, u in reversed(held["kept"][d]):
                d_h = d_h + d_states[t, :, own]
                m = mask[t][:, None]
                d_c = d_h * m * (1 - z) * (1 - c * c)
                d_z = -d_h * m * (c - h) * z * (1 - z)
                d_r = d_c * u * r * (1 - r)
                d_x[d][t] = np.hstack([d_z, d_r, d_c])
                d_u = np.hstack([d_z, d_r, d_c * r])
                g[f"h{d}"] += h.T @ d_u
                d_h = d_h * (1 - m * (1 - z)) + d_u @ p[f"h{d}"].T
            g[f"c{d}"] = d_x[d].sum(axis=(0, 1))
        return g, d_x

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {d: inputs @ self.p[f"x{d}"] + self.p[f"c{d}"] for d in "fb"}


@dataclass
class Model:
    share: float
    word_evidence: np.ndarray | None = None
    char_evidence: np.ndarray | None = None
    network: Network | None = None

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.share)
        if self.network is None:
            return out
        words = Words.of(data, offsets)
        first, length, text = windows(words.rows)
        if not len(first):
            return out
        fixed = fixed_inputs(words, self.word_evidence[words.places], self.char_evidence[words.grams])
        logits, _ = self.network.forward(self.network.project(self.network.inputs(words, fixed)), *_steps(words.which, first, length))
        full = np.flatnonzero(np.diff(words.rows) > 0)
        out[full] = _sigmoid(np.maximum.reduceat(logits, np.searchsorted(text, full)))
        return out


def _steps(which: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word index and mask of windows, step by step."""
    step = np.arange(WINDOW)[:, None]
    mask = step < length
    return which[np.where(mask, first + step, first)], mask.astype(np.float32)


def fixed_inputs(words: Words, own: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Evidence of each distinct word and of its n-grams (largest, mean), and its length."""
    out = np.zeros((len(own), FIXED_INPUTS), np.float32)
    if len(own):
        n = np.diff(words.gram_at)
        out[:, 0] = own
        out[:, 1] = np.maximum.reduceat(chars, words.gram_at[:-1])
        out[:, 2] = np.add.reduceat(chars, words.gram_at[:-1]) / n
        out[:, 3] = np.minimum(words.lengths, 12) / 10
    return out


def _evidence(with_: np.ndarray, without: np.ndarray, share: float) -> np.ndarray:
    """Shrunken log-odds against the label's share: 0 where nothing was seen."""
    post = (with_ + SHRINK * share) / (with_ + without + SHRINK)
    return (np.log(post / (1 - post)) - np.log(share / (1 - share))).astype(np.float32)


def _cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the fewest errors, both labels weighing the same, in the middle of the widest such gap."""
    order = np.argsort(logits, kind="stable")
    x, positive = logits[order], y[order] == 1
    missed = np.append(0, np.cumsum(positive)) / positive.sum()
    taken = np.append((~positive).sum() - np.append(0, np.cumsum(~positive))[:-1], 0) / (~positive).sum()
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gap = np.where(missed + taken <= (missed + taken).min() + 1e-9, np.diff(edges), -1.0)
    best = int(gap.argmax())
    return float((edges[best] + edges[best + 1]) / 2)


def train(rows: list[tuple[str, int]], share: float) -> Model:
    """A model from (text, label); ``share`` of label 1 among all training rows is the score without words."""
    rows = [(t, int(y)) for t, y in rows if t]
    labels = np.array([y for _, y in rows], np.float32)
    if not len(rows) or labels.min() == labels.max():
        return Model(share)
    texts_ = []
    for text, _ in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        texts_.append(Words.of(data, np.array([0, len(data)])))
    own_share = float(labels.mean())
    seen_words, seen_chars = np.zeros((2, 1 << WORD_BITS), np.float32), np.zeros((2, 1 << CHAR_BITS), np.float32)
    for words, y in zip(texts_, labels.astype(int).tolist()):
        seen_words[y, np.unique(words.places)] += 1
        seen_chars[y, np.unique(words.grams)] += 1
    fixed = []
    for words, y in zip(texts_, labels.astype(int).tolist()):
        less = np.array([[1 - y], [y]], np.float32)
        w, c = seen_words[:, words.places] - less, seen_chars[:, words.grams] - less
        fixed.append(fixed_inputs(words, _evidence(w[1], w[0], own_share), _evidence(c[1], c[0], own_share)))
        words.grams = words.gram_at = words.hashes = words.lengths = np.zeros(0, np.int64)  # their use ends here
    kept = [i for i, w in enumerate(texts_) if len(w.which)]
    if not kept:
        return Model(share)
    net = Network.new()
    first, length, of, which, base = [], [], [], [], 0
    for k, i in enumerate(kept):
        a, n, _ = windows(texts_[i].rows)
        first.append(a)
        length.append(n)
        of.append(np.full(len(a), k))
        which.append(texts_[i].which + base)
        base += len(fixed[i])
    shift = np.cumsum([0, *map(len, which)])[:-1]
    first = np.concatenate([a + s for a, s in zip(first, shift)])
    length, of, which = np.concatenate(length), np.concatenate(of), np.concatenate(which)
    given = np.concatenate([fixed[i] for i in kept])
    trigrams = np.concatenate([texts_[i].trigrams for i in kept])
    sizes = np.concatenate([np.diff(texts_[i].trigram_at) for i in kept])
    trigram_at = np.append(0, np.cumsum(sizes))
    del texts_, fixed
    y = labels[kept]
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    begins = np.searchsorted(of, np.arange(len(kept)))

    def all_inputs() -> np.ndarray:
        out = np.zeros((len(given), INPUTS), np.float32)
        out[:, :FIXED_INPUTS] = given
        for a in range(0, len(given), 1 << 16):
            b = min(a + (1 << 16), len(given))
            own = trigrams[trigram_at[a] : trigram_at[b]]
            out[a:b, FIXED_INPUTS:] = np.add.reduceat(net.p["trigrams"][own], trigram_at[a:b] - trigram_at[a], axis=0) / sizes[a:b, None]
        return out

    def all_logits() -> np.ndarray:
        inputs, out = all_inputs(), []
        for a in range(0, len(first), 2048):
            # These windows are of neighbouring texts, so their inputs stand together.
            index, mask = _steps(which, first[a : a + 2048], length[a : a + 2048])
            low = index.min()
            out.append(net.forward(net.project(inputs[low : index.max() + 1]), index - low, mask)[0])
        return np.concatenate(out)

    def top(values: np.ndarray) -> np.ndarray:
        high = np.repeat(np.maximum.reduceat(values, begins), np.diff(np.append(begins, len(values))))
        hits = np.flatnonzero(values == high)
        return hits[np.searchsorted(hits, begins)]

    # The first choice is by evidence; later ones are the network's.
    strength = np.append(0, np.cumsum(np.maximum(given[which, 0] + given[which, 1], 0)))
    chosen = top(strength[first + length] - strength[first])
    first_moment, second_moment, turn = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    rng = np.random.default_rng(11)
    rank = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0))
    active = rank <= BEGIN
    epochs = max(EPOCHS, -(-UPDATES * BATCH // int(active.sum())))
    for epoch in range(epochs):
        if epoch in (epochs // 3, 2 * epochs // 3):
            logits = all_logits()
            chosen = top(logits)
            wrong = np.where(active, -np.inf, np.where(y == 1, -1, 1) * logits[chosen])
            for label in (0, 1):
                worst = np.argsort(-np.where(y == label, wrong, -np.inf), kind="stable")[:ADD]
                active[worst[np.isfinite(wrong[worst]) & (y[worst] == label)]] = True
        for batch in np.array_split(rng.permutation(np.flatnonzero(active)), max(1, int(active.sum()) // BATCH)):
            own = chosen[batch]
            index, mask = _steps(which, first[own], length[own])
            used, local = np.unique(index, return_inverse=True)
            local = local.reshape(index.shape)
            spans = K.ranges(trigram_at[used], sizes[used])
            mean_at = np.append(0, np.cumsum(sizes[used]))
            mean = np.add.reduceat(net.p["trigrams"][trigrams[spans]], mean_at[:-1], axis=0) / sizes[used][:, None]
            x = np.hstack([given[used], mean]).astype(np.float32)
            x[:, :3] *= 1 - NOISE * rng.random((len(x), 3), np.float32)
            logits, held = net.forward(net.project(x), local, mask, keep=True)
            error = ((_sigmoid(logits) - y[batch]) * weight[batch] / len(batch)).astype(np.float32)
            grads, d_projected = net.backward(held, mask, error)
            d_x = np.zeros_like(x)
            for d in "fb":
                flat = np.zeros((len(used), 3 * HIDDEN), np.float32)
                np.add.at(flat, local.reshape(-1), d_projected[d].reshape(-1, 3 * HIDDEN))
                grads[f"x{d}"] = x.T @ flat
                d_x += flat @ net.p[f"x{d}"].T
            grads["trigrams"] = np.zeros_like(net.p["trigrams"])
            np.add.at(grads["trigrams"], trigrams[spans], np.repeat(d_x[:, FIXED_INPUTS:] / sizes[used][:, None], sizes[used], axis=0))
            turn += 1
            for k, v in net.p.items():
                gradient = grads[k] + DECAY * v
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * gradient
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * gradient * gradient
                net.p[k] = (v - RATE * (first_moment[k] / (1 - 0.9**turn)) / (np.sqrt(second_moment[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    net.p["bias"] += np.float32(np.log(PREDICT / (1 - PREDICT)) - _cut(np.maximum.reduceat(all_logits(), begins), y))
    return Model(share, _evidence(seen_words[1], seen_words[0], own_share), _evidence(seen_chars[1], seen_chars[0], own_share), net)


def fit(docs: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3, per_label: int = PER_LABEL) -> Model:
    """Train on a bounded sample of the labelled rows outside the held-out fold, in a task; the driver gets the weights alone."""
    teaches = labels.where((remainder(F.col("doc_id"), folds) != fold) & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("label"))
    share = float(teaches.agg(F.avg("label")).first()[0] or 0.0)
    ship(docs.sparkSession)

    def run(batches):
        rows = [r for batch in batches for r in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows, share))], pa.binary())], ["model"])

    sample = sample_rows(docs, teaches, per_label).coalesce(1).sortWithinPartitions("doc_id")
    # A table without rows may have no task at all.
    found = sample.select("text", "label").mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else train([], share)


def score(docs: DataFrame, model: Model, fold: int = 1, folds: int = 3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    rows = texts(docs).withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), folds) == fold, F.lit(False)))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = held.value.scores(*byte_buffer(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= PREDICT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_blocks(rows, block, "doc_id bigint, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``, with all its columns, without the documents predicted toxic."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return filter_blocks(docs, lambda batch: held.value.scores(*byte_buffer(batch.column("text"))) < PREDICT)
