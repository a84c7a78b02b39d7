"""Benchmark decontamination with a BM25 inverted index of test items.

The index holds the items as documents (items longer than ``PIECE`` words as
overlapping pieces). Every passage of every text (``PASSAGE`` words, each
``STEP`` words) is a query of its distinct words, and all items are retrieved
whose BM25 score is at least ``THRESHOLD`` of the item's score for itself;
with impacts divided by that, the threshold is one number for all items.

Retrieval is weak-AND with block maxima, over all passages of a block of
texts at once: an item's words are essential from the rarest on until the
rest has less than ``REST`` of its score, so a passage must reach the
threshold less that by essential words. Essential postings add up per passage and
block of ``ITEMS`` items with the block's largest impact of each word; where
that sum and the block's largest rest stay below the threshold, the block is
skipped; only the others get exact scores.

An item may stand in a document in parts, none of which fills a passage. So
the passages of a document also query together, with all their distinct words,
and retrieve the items whose score reaches the item's own bound: that of its
words less the most that can be absent while ``SHINGLE_SHARE`` of the
shingles stand there (``most_absent``). No item that verification would accept
stays under that bound, wherever its parts stand.

What is retrieved is verified in the whole text by the share of the item's
five-word shingles that stand there. The shares of the words of its question
(all but the last sentence) and its answer (the last one) that those cover are
reported; a last sentence may be a word, so they refuse nothing.

The benchmark is held in every task, in blocks of at most ``INDEX_BYTES`` of
text; each block of items is one pass over the texts.

Defined results: items without words match nothing; null texts count as
empty; of repeated items (equal item_id) each is checked, and a pair is
returned once per row of the documents; an empty table on either side gives
an empty result; other columns are dropped.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import kernels as K
from cadenza.llm.common import byte_buffer, filter_blocks, map_blocks, texts

PASSAGE, STEP, PIECE = 64, 32, 48
K1, B = 1.2, 0.75
#: Share of an item's own score at which a passage retrieves it.
THRESHOLD = 0.5
#: An item's words are essential, from the rarest on, until the others' share of its score is below this.
REST = 0.15
SHINGLE_WORDS = 5
#: Share of its shingles that verifies a retrieved item.
SHINGLE_SHARE = 0.8
#: Items of one block of the index.
ITEMS = 8
#: Benchmark text held in a task at once.
INDEX_BYTES = 16 << 20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and row offsets: runs of 0-9, a-z, non-ASCII after A-Z became lower case."""
    low = K.LOWER[data]
    starts, ends, rows = K.word_spans(low, offsets, K.ALNUM)
    return K.slice_hashes(low, starts, ends), rows


def _text_words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return _words(data, np.array([0, len(data)]))[0]


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    shingles: np.ndarray
    answer: int  # its first word

    @classmethod
    def of(cls, item_id: int, text: str) -> Item:
        words = _text_words(text)
        shingles, _ = K.shingle_hashes(words, np.array([0, len(words)]), SHINGLE_WORDS)
        last = re.split(r"(?<=[.!?\n])\s*(?=\S)", text.strip())[-1]
        answer = len(words) - len(_text_words(last))
        return cls(item_id, words, shingles, answer if 0 < answer < len(words) else 0)

    def overlap(self, there: np.ndarray) -> tuple[float, float, float]:
        """Shares of the shingles, question words and answer words found, given the sorted shingles of a text."""
        at = np.minimum(np.searchsorted(there, self.shingles), max(len(there) - 1, 0))
        hit = there[at] == self.shingles if len(there) else np.zeros(len(self.shingles), bool)
        _, first = np.unique(self.shingles, return_index=True)
        covered = np.zeros(len(self.words), bool)
        for i in np.flatnonzero(hit).tolist():
            covered[i : i + SHINGLE_WORDS] = True
        question = covered[: self.answer] if self.answer else covered
        return float(hit[first].mean()), float(question.mean()), float(covered[self.answer :].mean())


def most_absent(weights: np.ndarray, missing: int, distinct: bool) -> float:
    """The largest weight of words that a text can lack while it lacks at most ``missing`` of their shingles.

    ``weights`` has a weight per word of an item of at least ``SHINGLE_WORDS`` words, 0 where a word comes
    again; ``distinct``: no shingle comes twice. Each absent word takes with it all shingles that it is in, so
    a dynamic program over the places of absent words counts the shingles that go. With repeated shingles the
    ``missing + 4`` largest weights are a bound: the shingles that end with the absent words' first places are
    distinct, but for the first four words.
    """
    if not missing:
        return 0.0
    if not distinct:
        return float(np.sort(weights)[::-1][: missing + SHINGLE_WORDS - 1].sum())
    n, last = len(weights), len(weights) - SHINGLE_WORDS
    # best[k]: the largest weight for at most k shingles, up to a place; own[q]: the same with q the last absent place.
    best, own = np.zeros(missing + 1), []
    none = np.full(missing + 1, -np.inf)
    far = [none] * n  # the best whose last absent place is at most this one
    for p in range(n):
        found = none.copy()
        for q in (None, *range(max(0, p - SHINGLE_WORDS + 1), p)):
            first = max(p - SHINGLE_WORDS + 1, 0) if q is None else max(p - SHINGLE_WORDS + 1, q + 1, 0)
            cost = max(0, min(p, last) - first + 1)
            before = (np.maximum(0.0, far[p - SHINGLE_WORDS]) if p >= SHINGLE_WORDS else np.zeros(missing + 1)) if q is None else own[q]
            if cost <= missing:
                found[cost:] = np.maximum(found[cost:], before[: missing + 1 - cost])
        own.append(found + weights[p])
        far[p] = np.maximum(far[p - 1] if p else none, own[p])
        best = np.maximum(best, own[p])
    return float(best.max())


class Index:
    """Normalised impacts of the items' words: essential postings by block, and all of them by piece."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.items = [x for x in (Item.of(i, t) for i, t in rows) if len(x.words)]
        self.pieces: list[tuple[int, np.ndarray]] = []  # item, its distinct words with counts below
        counts = []
        for k, item in enumerate(self.items):
            n = len(item.words)
            for a in range(0, max(1, n - PIECE + PIECE // 2), PIECE // 2) if n > PIECE else [0]:
                a = min(a, max(n - PIECE, 0))
                words, count = np.unique(item.words[a : a + PIECE], return_counts=True)
                self.pieces.append((k, words))
                counts.append(count)
        self.vocabulary = np.unique(np.concatenate([w for _, w in self.pieces])) if self.pieces else np.zeros(0, np.uint64)
        df = Counter(np.searchsorted(self.vocabulary, np.concatenate([w for _, w in self.pieces])).tolist()) if self.pieces else Counter()
        n, mean = len(self.pieces), np.mean([c.sum() for c in counts]) if counts else 1.0
        idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        self.impacts: list[dict[int, float]] = []
        for (_, words), count in zip(self.pieces, counts):
            terms = np.searchsorted(self.vocabulary, words).tolist()
            raw = {t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * count.sum() / mean)) for t, c in zip(terms, count.tolist())}
            own = sum(raw.values())
            self.impacts.append({t: v / own for t, v in raw.items()})
        self._whole_items(idf, mean)
        self.n_blocks = -(-n // ITEMS)
        rest = np.zeros(self.n_blocks)
        block_max: dict[tuple[int, int], float] = defaultdict(float)
        for p, impacts in enumerate(self.impacts):
            b, left = p // ITEMS, 1.0
            for t in sorted(impacts, key=lambda t: (df[t], t)):
                if left < REST:
                    break
                block_max[t, b] = max(block_max[t, b], impacts[t])
                left -= impacts[t]
            rest[b] = max(rest[b], left)
        self.rest = rest
        order = sorted(block_max)
        self.post_block = np.array([b for _, b in order], np.int64)
        self.post_value = np.array([block_max[k] for k in order])
        self.post_at = np.searchsorted(np.array([t for t, _ in order], np.int64), np.arange(len(self.vocabulary) + 1))

    def _whole_items(self, idf: dict[int, float], mean: float) -> None:
        """Postings of the items as a whole: their essential words, by block, as shares of what a document needs of them."""
        self.item_words: list[np.ndarray] = []
        self.item_weights: list[np.ndarray] = []
        self.item_bounds: list[float] = []
        block_max: dict[tuple[int, int], float] = defaultdict(float)
        for i, item in enumerate(self.items):
            words, first, count = np.unique(item.words, return_index=True, return_counts=True)
            terms = np.searchsorted(self.vocabulary, words)
            raw = np.array([idf[t] for t in terms.tolist()]) * count * (K1 + 1) / (count + K1 * (1 - B + B * len(item.words) / mean))
            raw /= raw.sum()
            placed = np.zeros(len(item.words))
            placed[first] = raw
            shingles = len(np.unique(item.shingles))
            absent = 0.0
            if len(item.words) >= SHINGLE_WORDS:
                missing = shingles - math.ceil(SHINGLE_SHARE * shingles - 1e-9)
                absent = most_absent(placed, missing, shingles == len(item.shingles))
            bound = max(1.0 - absent - 1e-9, 1e-9)
            self.item_words.append(terms)
            self.item_weights.append(raw)
            self.item_bounds.append(bound)
            order = np.lexsort((terms, [-idf[t] for t in terms.tolist()]))
            rest = 1.0 - np.cumsum(raw[order])
            essential = order[: int(np.searchsorted(-rest, -bound * REST, "right")) + 1]
            need = bound - max(1.0 - raw[essential].sum(), 0.0)
            for t, w in zip(terms[essential].tolist(), raw[essential].tolist()):
                block_max[t, i // ITEMS] = max(block_max[t, i // ITEMS], w / need)
        keys = sorted(block_max)
        self.whole_block = np.array([b for _, b in keys], np.int64)
        self.whole_value = np.array([block_max[k] for k in keys])
        self.whole_at = np.searchsorted(np.array([t for t, _ in keys], np.int64), np.arange(len(self.vocabulary) + 1))

    def retrieve_whole(self, terms: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, item) of every document and the items of which it has enough words; ``terms`` and ``row`` are of all known words."""
        distinct = np.unique(row * len(self.vocabulary) + terms)
        row, terms = np.divmod(distinct, len(self.vocabulary))
        length = self.whole_at[terms + 1] - self.whole_at[terms]
        at = K.ranges(self.whole_at[terms], length)
        blocks_ = -(-len(self.items) // ITEMS)
        keys, where = np.unique(np.repeat(row, length) * blocks_ + self.whole_block[at], return_inverse=True)
        keys = keys[np.bincount(where, self.whole_value[at], len(keys)) >= 1.0 - 1e-9]
        of, have = -1, np.zeros(len(self.vocabulary), bool)
        for r, b in zip((keys // blocks_).tolist(), (keys % blocks_).tolist()):
            if r != of:
                have[:] = False
                have[terms[np.searchsorted(row, r) : np.searchsorted(row, r + 1)]] = True
                of = r
            for i in range(b * ITEMS, min(len(self.items), (b + 1) * ITEMS)):
                if self.item_weights[i][have[self.item_words[i]]].sum() >= self.item_bounds[i] - 1e-9:
                    yield r, i

    def candidates(self, terms: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Keys ``passage * n_blocks + block`` whose bound reaches the threshold; passage i covers steps i and i + 1."""
        distinct = np.unique(step * len(self.vocabulary) + terms)
        step, terms = np.divmod(distinct, len(self.vocabulary))
        length = self.post_at[terms + 1] - self.post_at[terms]
        at = K.ranges(self.post_at[terms], length)
        step = np.repeat(step, length)
        # A step belongs to the passage that begins with it and to the one before; a word of both counts twice, which keeps the bound.
        keys = np.concatenate([step, step - 1]) * self.n_blocks + np.tile(self.post_block[at], 2)
        values = np.tile(self.post_value[at], 2)
        keys, where = np.unique(keys, return_inverse=True)
        total = np.bincount(where, values, len(keys)) + self.rest[keys % self.n_blocks]
        return keys[total >= THRESHOLD]

    def retrieve(self, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(row, item, score) of every passage's items at or above the threshold, and with score 0 what a whole document retrieves; an item may come more than once."""
        if not len(self.vocabulary) or not len(hashes):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == hashes)
        if not len(known):
            return
        # Steps are counted through the block; each row has one more before it, so no passage spans two rows.
        per_row = -(-np.diff(rows) // STEP) + 1
        first = np.cumsum(per_row) - per_row + 1
        row = np.searchsorted(rows, known, "right") - 1
        step = first[row] + (known - rows[row]) // STEP
        terms = at[known]
        by_passage: dict[int, list[int]] = defaultdict(list)
        for key in self.candidates(terms, step).tolist():
            by_passage[key // self.n_blocks].append(key % self.n_blocks)
        for passage, found in by_passage.items():
            a, b = np.searchsorted(step, (passage, passage + 2))
            have = set(terms[a:b].tolist())
            for block in found:
                for p in range(block * ITEMS, min(len(self.pieces), (block + 1) * ITEMS)):
                    impacts = self.impacts[p]
                    score = sum(impacts[t] for t in have.intersection(impacts))
                    if score >= THRESHOLD:
                        yield int(row[a]), self.pieces[p][0], score
        for r, item in self.retrieve_whole(terms, row):
            yield r, item, 0.0

    def best_passage(self, item: int, hashes: np.ndarray) -> float:
        """The item's highest score in a passage of one text."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == hashes)
        own = [impacts for (k, _), impacts in zip(self.pieces, self.impacts) if k == item]
        best = 0.0
        for start in np.unique(known // STEP).tolist():
            have = set(at[known[np.searchsorted(known, start * STEP) : np.searchsorted(known, start * STEP + PASSAGE)]].tolist())
            best = max(best, *(sum(x[t] for t in have.intersection(x)) for x in own))
        return best

    def verified(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float, float, float]]:
        """(row, item_id, score, shingle share, question share, answer share) of what was retrieved and holds in the whole text."""
        hashes, rows = _words(data, offsets)
        best: dict[tuple[int, int], float] = {}
        for row, item, score in self.retrieve(hashes, rows):
            best[row, item] = max(score, best.get((row, item), 0.0))
        out, of, there = [], -1, np.zeros(0, np.uint64)
        for (row, item), score in sorted(best.items()):
            if row != of:
                words = hashes[rows[row] : rows[row + 1]]
                of, there = row, np.unique(K.shingle_hashes(words, np.array([0, len(words)]), SHINGLE_WORDS)[0])
            own = self.items[item]
            if len(own.words) < SHINGLE_WORDS:  # one shingle, the whole item, at any place
                words = hashes[rows[row] : rows[row + 1]]
                n = len(own.words)
                stands = len(words) >= n and (np.lib.stride_tricks.sliding_window_view(words, n) == own.words).all(axis=1).any()
                share = question = answer = float(stands)
            else:
                share, question, answer = own.overlap(there)
            if share >= SHINGLE_SHARE:
                score = score or self.best_passage(item, hashes[rows[row] : rows[row + 1]])
                out.append((row, own.item_id, min(score, 1.0), share, question, answer))
        return out


def index_blocks(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes of the benchmark, each over at most about ``index_bytes`` of item text (by a hash of the item)."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / index_bytes)) if total > index_bytes else 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect() if n > 1 else items.collect()
        if rows:
            yield Index(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


SCHEMA = "doc_id bigint, item_id bigint, score double, shingle_share double, question_share double, answer_share double"


def contaminated(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """A row for every document and test item that it holds."""
    out = None
    for index in index_blocks(benchmark, index_bytes):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def block(batch: pa.RecordBatch, held=held) -> pa.RecordBatch | None:
            found = held.value.verified(*byte_buffer(batch.column("text")))
            if not found:
                return None
            row, *rest = zip(*found)
            kinds = [pa.int64(), *[pa.float64()] * 4]
            return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), *[pa.array(x, k) for x, k in zip(rest, kinds)]], [x.split()[0] for x in SCHEMA.split(", ")])

        found = map_blocks(texts(docs), block, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs``, with all its columns, without the documents that hold a test item."""
    for index in index_blocks(benchmark, index_bytes):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batch: pa.RecordBatch, held=held) -> np.ndarray:
            out = np.ones(batch.num_rows, bool)
            out[[f[0] for f in held.value.verified(*byte_buffer(batch.column("text")))]] = False
            return out

        docs = filter_blocks(docs, clean)
    return docs
