"""Language identification by hierarchical discrimination.

A text's features are the relative frequencies of its hashed byte bigrams and
trigrams (A-Z as lower case), each scaled by the root of its mean frequency.
Linear support vector machines, one per pair of families, vote for the
family; those of the pairs of languages inside it vote for the language. Ties
in votes go to the larger sum of margins, then to the earlier name.

The machines are fitted on the driver on at most ``PER_LANGUAGE`` labelled
texts of each language, chosen by a hash of doc_id; every text is scored in
whole. ``score`` is the product of the logistic values of the winner's mean
margin at both levels.

Defined results: ``und`` with score 0 for null text, text without a letter,
or when nothing could be learned; rows with a null lang teach nothing;
repeated rows each get their row; a null doc_id is never held out and teaches
nothing; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm import kernels as K
from cadenza.llm import svm
from cadenza.llm.common import byte_buffer, labelled_sample, map_blocks, remainder, texts

#: Labelled texts per language that the machines are fitted on.
PER_LANGUAGE = 600
#: Hashed n-grams.
FEATURES = 1 << 12
#: Families of language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
}


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower().split("-")[0] in codes), lang)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 2 and 3 bytes: the feature at each byte, and the n + 1 row offsets of those that stay in their row."""
    v = K.LOWER[data].astype(np.uint32)
    out = []
    h = v * np.uint32(0x9E3779B1)
    for size in (2, 3):
        nxt = np.zeros(len(v), np.uint32)
        nxt[: max(len(v) - size + 1, 0)] = v[size - 1 :]
        h = (h ^ nxt) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        inside = np.ones(len(v), bool)
        for back in range(1, size):
            last = offsets[1:] - back
            inside[last[last >= offsets[:-1]]] = False
        feature = (h >> np.uint32(20 if FEATURES == 1 << 12 else 16)) % np.uint32(FEATURES)
        kept = np.flatnonzero(inside)
        out.append((feature[kept], np.searchsorted(kept, offsets)))
    return out


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between offsets."""
    out = np.zeros((len(at) - 1, values.shape[1]), np.float64)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, at[full], axis=0, dtype=np.float64)
    return out


@dataclass
class Model:
    """Machines as columns of ``weights`` (features) and ``bias``; ``families`` and ``languages`` name their pairs."""

    weights: np.ndarray
    bias: np.ndarray
    families: list[str]
    members: dict[str, list[str]]
    columns: dict[tuple[str, str], int]

    def _vote(self, margins: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The winner's place in ``names`` for each row, and the logistic value of its mean margin."""
        votes, sums = np.zeros((len(margins), len(names))), np.zeros((len(margins), len(names)))
        for i, j in combinations(range(len(names)), 2):
            m = margins[:, self.columns[names[i], names[j]]]
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            sums[:, i] += m
            sums[:, j] -= m
        order = votes + 1e-3 * np.tanh(sums)
        best = order.argmax(axis=1)
        mean = sums[np.arange(len(margins)), best] / max(len(names) - 1, 1)
        return best, 1 / (1 + np.exp(-3 * mean)) if len(names) > 1 else np.ones(len(margins))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        sums, total = np.zeros((len(offsets) - 1, self.weights.shape[1])), np.zeros(len(offsets) - 1)
        for feature, at in ngrams(data, offsets):
            sums += row_sums(self.weights[feature], at)
            total += np.diff(at)
        margins = sums / np.maximum(total, 1)[:, None] + self.bias
        who, score = self._vote(margins, self.families)
        lang = np.empty(len(who), object)
        for f, name in enumerate(self.families):
            own = np.flatnonzero(who == f)
            if len(own):
                best, inner = self._vote(margins[own], self.members[name])
                lang[own] = [self.members[name][i] for i in best]
                score[own] *= inner
        return lang.tolist(), score


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """A model from (text, lang); ``None`` from none."""
    rows = sorted(r for r in rows if r[0])
    if not rows:
        return None
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, (text, _) in enumerate(rows):
        data = np.frombuffer(text.encode(), np.uint8)
        for feature, _ in ngrams(data, np.array([0, len(data)])):
            x[i] += np.bincount(feature, minlength=FEATURES)
    x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
    x *= scale
    length = np.sqrt((x * x).sum(axis=1).mean()) or 1.0
    x /= length
    langs = np.array([lang for _, lang in rows])
    groups = np.array([family(lang) for lang in langs])
    families = sorted(set(groups.tolist()))
    members = {f: sorted(set(langs[groups == f].tolist())) for f in families}
    weights, bias, columns = [], [], {}

    def pair(a: str, b: str, of: np.ndarray) -> None:
        own = (of == a) | (of == b)
        w = svm.fit(x[own], np.where(of[own] == a, 1.0, -1.0), cost=10.0)
        columns[a, b] = len(bias)
        weights.append(w[:-1] * scale / length)
        bias.append(float(w[-1]))

    for a, b in combinations(families, 2):
        pair(a, b, groups)
    for f in families:
        for a, b in combinations(members[f], 2):
            pair(a, b, langs)
    table = np.stack(weights, axis=1).astype(np.float32) if weights else np.zeros((FEATURES, 1), np.float32)
    return Model(table, np.array(bias or [0.0]), families, members, columns)


def no_letter(texts_: list[str], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = K.LOWER[data]
    ascii_ = np.append(0, np.cumsum((low >= 0x61) & (low <= 0x7A)))
    out = ascii_[offsets[1:]] == ascii_[offsets[:-1]]
    for i in np.flatnonzero(out).tolist():
        out[i] = not any(c.isalpha() for c in texts_[i])
    return out


def identify(docs: DataFrame, model: Model | None, held_out: Column) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    rows = texts(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("text")
        data, offsets = byte_buffer(column)
        lang, score = model.predict(data, offsets) if model else (["und"] * batch.num_rows, np.zeros(batch.num_rows))
        for i in np.flatnonzero(no_letter(column.to_pylist(), data, offsets)).tolist():
            lang[i], score[i] = "und", 0.0
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return map_blocks(rows, block, "doc_id bigint, held_out boolean, lang_pred string, score double")


def predict_languages(docs: DataFrame, fold: int = 2, folds: int = 4, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Fit on the rows outside the held-out fold, predict all."""
    part = remainder(F.col("doc_id"), folds)
    labelled = docs.where(part != fold).select("doc_id", F.col("lang").alias("label"))
    model = fit(labelled_sample(docs, labelled, per_language, F.col("lang")))
    return identify(docs, model, part == fold)
