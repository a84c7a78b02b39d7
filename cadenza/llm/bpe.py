"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The pre-token boundaries of the public pattern are found without a regular
expression. Every code point of a block gets a class (letter, number, white
space, other). A boundary automaton reads the classes: its state is the start
of the run it is in, and each code point's transition either resets that state
to its own place or keeps it. Such transition functions compose associatively
(the last reset wins), so one scan (``maximum.accumulate``) yields the state
at every place. Local rules on the run ends then add the optional leading
space, the last white-space character and the contractions.

The slices feed pair merging with a bounded cache: one entry per distinct
slice. Ids keep their byte lengths, so offsets of tokens in the text and the
decoded bytes follow from the ids alone.

Defined results: null and empty texts have no ids; text is taken as UTF-8;
repeated rows are encoded one by one; an empty table gives an empty result;
columns other than doc_id and text are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadenza.llm import kernels as K
from cadenza.llm.common import byte_buffer, map_blocks, texts

#: Distinct slices kept by one worker's cache; when full it starts anew.
CACHE_SLICES = 1 << 18
#: Longer slices (bytes) are merged one by one.
LONG_SLICE = 96
NO_RANK = 1 << 60

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: White space of the pattern's ``\s`` (Unicode White_Space).
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, from its general category."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    names = {"L": LETTER, "N": NUMBER}
    for cp in range(sys.maxunicode + 1):
        out[cp] = names.get(unicodedata.category(chr(cp))[0], OTHER)
    out[list(WHITE)] = SPACE
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a UTF-8 block, the byte place of each (n + 1), and the row offsets in code points."""
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    lead = (data & 0xC0) != 0x80
    cps = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.append(np.flatnonzero(lead), len(data))
    return cps, at, np.searchsorted(at, offsets)


def boundaries(cps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places (in code points) where a slice begins; the slices tile the block and stop at row ends."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    cls = _classes()[cps]
    place = np.arange(n)
    head = np.zeros(n + 1, bool)
    head[rows] = True
    reset = head[:n].copy()
    reset[1:] |= cls[1:] != cls[:-1]
    # The scan of the transition functions: reset -> own place, keep -> the state before.
    run = np.maximum.accumulate(np.where(reset, place, 0))
    begin = reset.copy()
    last = np.empty(n, bool)  # of its run
    last[-1] = True
    last[:-1] = reset[1:]
    # White space before text of the same row gives its last character away.
    gives = last & (cls == SPACE) & ~head[1:]
    begin[np.flatnonzero(gives)] = True
    # A plain space given away leads the next slice, which then doesn't begin at its own run.
    leads = np.flatnonzero(gives & (cps == 32))
    begin[leads + 1] = False
    # Contractions: an apostrophe that is a run of its own and isn't led by a space.
    quote = np.flatnonzero((cps == 39) & (run == place) & last)
    if len(quote):
        before = np.where(head[quote] | (quote == 0), 0, cps[quote - 1])
        quote = quote[(before != 32) & ~head[quote + 1]]
        room = np.append(cps, np.zeros(2, np.uint32))
        one, two = room[quote + 1], room[quote + 2]
        two = np.where(head[np.minimum(quote + 2, n)], 0, two)
        single = np.isin(one, (115, 116, 109, 100))
        double = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        quote, size = quote[single | double], np.where(single, 1, 2)[single | double]
        begin[quote + 1] = False
        ends = quote + 1 + size
        ends = ends[ends < n]
        # What follows starts anew, unless a space there leads it (that space begins anyway).
        begin[ends] = True
    return np.flatnonzero(begin)


class PairTable:
    """(left id, right id) -> id of their concatenation, as an open-addressed table of arrays."""

    def __init__(self, rank: dict[bytes, int]) -> None:
        keys, values = [], []
        for piece, r in rank.items():
            for cut in range(1, len(piece)):
                left, right = rank.get(piece[:cut]), rank.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(r)
        keys, values = np.array(keys, np.int64), np.array(values, np.int64)
        self.bits = max(8, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int64)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] < 0
            take = todo[free]
            self.keys[slot[take]] = keys[take]  # of several for one slot the last stays; the others go on
            won = take[self.keys[slot[take]] == keys[take]]
            self.values[slot[won]] = values[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            todo = todo[rest[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (K.mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NO_RANK)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out


class SliceCache:
    """Ids of slices met before: a dictionary to places in growing arrays, emptied when full."""

    def __init__(self, limit: int = CACHE_SLICES) -> None:
        self.limit = limit
        self._empty()

    def _empty(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids, self.starts, self.counts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    @staticmethod
    def _room(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])

    def encode(self, pieces: list[bytes], merge) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices end to end, and their counts; ``merge`` gives them for the new ones."""
        if len(self.slots) > self.limit:
            self._empty()
        slots = self.slots
        new = [p for p in pieces if p not in slots]
        if new:
            ids, counts = merge(new)
            a, b = len(slots), len(slots) + len(new)
            self.ids, self.starts, self.counts = self._room(self.ids, self.used + len(ids)), self._room(self.starts, b), self._room(self.counts, b)
            self.ids[self.used : self.used + len(ids)] = ids
            self.counts[a:b] = counts
            self.starts[a:b] = self.used + np.cumsum(counts) - counts
            self.used += len(ids)
            slots.update(zip(new, range(a, b)))
        at = np.fromiter(map(slots.__getitem__, pieces), np.int64, len(pieces))
        counts = self.counts[at]
        return self.ids[K.ranges(self.starts[at], counts)], counts


class Ranks:
    """A vocabulary file of ranks, read once per worker."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = {b: a for a, b in self.rank.items()}
        self.byte_ids = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)
        self.piece_bytes = np.zeros(max(self.pieces) + 1, np.int32)
        self.piece_bytes[list(self.pieces)] = [len(x) for x in self.pieces.values()]
        self.pairs = PairTable(self.rank)
        self.cache = SliceCache()

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices end to end, and their counts.

        Of each slice the adjacent pair of lowest rank, the leftmost of equals,
        merges until none has one: one merge of every open slice per turn, over
        all slices at once.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        room = np.cumsum(lengths) - lengths
        flat, counts = np.zeros(int(lengths.sum()), np.uint32), np.zeros(len(pieces), np.int64)
        whole = np.fromiter(map(self.rank.get, pieces, repeat(NO_RANK)), np.int64, len(pieces))
        one = whole != NO_RANK
        flat[room[one]], counts[one] = whole[one], 1
        for i in np.flatnonzero(~one & (lengths > LONG_SLICE)).tolist():
            ids = self._merge_long(pieces[i])
            flat[room[i] : room[i] + len(ids)], counts[i] = ids, len(ids)
        which = np.flatnonzero(~one & (lengths <= LONG_SLICE))
        ids = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in which.tolist()]), np.uint8)]
        sizes = lengths[which]
        rank = None
        while len(which):
            ends = np.cumsum(sizes)
            starts = ends - sizes
            if rank is None:
                rank = np.full(len(ids), NO_RANK, np.int64)
                rank[:-1] = self.pairs.find(ids[:-1], ids[1:])
                rank[ends - 1] = NO_RANK
            low = np.minimum.reduceat(rank, starts)
            done = low == NO_RANK
            if done.any():
                flat[K.ranges(room[which[done]], sizes[done])] = ids[K.ranges(starts[done], sizes[done])]
                counts[which[done]] = sizes[done]
                keep = np.repeat(~done, sizes)
                ids, rank, which, sizes, low = ids[keep], rank[keep], which[~done], sizes[~done], low[~done]
                if not len(which):
                    break
                ends = np.cumsum(sizes)
                starts = ends - sizes
            hits = np.flatnonzero(rank == np.repeat(low, sizes))
            at = hits[np.searchsorted(hits, starts)]
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, rank = ids[keep], rank[keep]
            at -= np.arange(len(at))
            sizes = sizes - 1
            ends = np.cumsum(sizes)
            right = at[at < ends - 1]
            rank[at] = NO_RANK
            rank[right] = self.pairs.find(ids[right], ids[right + 1])
            left = at[at > ends - sizes] - 1
            rank[left] = self.pairs.find(ids[left], ids[left + 1])
        return flat[K.ranges(room, counts)], counts

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same order of merges by a heap over a linked list, for one very long slice."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        n, get = len(parts), self.rank.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, b""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and (y := after[x]) >= 0 and (r := get(parts[x] + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return tuple(self.rank[p] for p in parts if p)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` through the cache."""
        return self.cache.encode(pieces, self.merge)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


def distinct_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct slice, and which of them each slice is; the slices tile ``data``.

    Slices of equal hash are compared byte by byte; should two differ, all are told apart by their bytes.
    """
    _, first, which = np.unique(K.slice_hashes(data, starts, ends), return_index=True, return_inverse=True)
    same = first[which]
    lengths = ends - starts
    if np.array_equal(lengths, lengths[same]) and np.array_equal(data, data[K.ranges(starts[same], lengths)]):
        return first, which
    raw, places = data.tobytes(), {}
    which = np.array([places.setdefault(raw[s:e], len(places)) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)
    return np.unique(which, return_index=True)[1], which


def encode_block(data: np.ndarray, offsets: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block, end to end, and the n + 1 row offsets into them.

    ``encode(pieces)`` gets each distinct slice of the block once and returns ids, end to end, and counts.
    """
    cps, at, rows = code_points(data, offsets)
    begin = boundaries(cps, rows)
    if not len(begin):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    starts, ends = at[begin], at[np.append(begin[1:], len(cps))]
    first, which = distinct_slices(data, starts, ends)
    raw = data.tobytes()
    pool, sizes = encode([raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())])
    pool_at = np.cumsum(sizes) - sizes
    lengths = sizes[which]
    ids = pool[K.ranges(pool_at[which], lengths)]
    total = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    return ids, total[np.searchsorted(begin, rows)]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>, lengths array<int>``: ids and the byte length of each (its offset on decoding)."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranks = load_ranks(path)
        ids, rows = encode_block(*byte_buffer(batch.column("text")), ranks.encode)
        sizes = ranks.piece_bytes[ids]
        lists = [pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(x.astype(np.int32))) for x in (ids, sizes)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "ids", "lengths"])

    return map_blocks(texts(docs), block, "doc_id bigint, ids array<int>, lengths array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; bytes that aren't UTF-8 are replaced (whole texts always are)."""
    from cadenza.llm.common import ship

    ship(encoded.sparkSession)

    def run(batches):
        ranks = load_ranks(path)
        for batch in batches:
            out = [ranks.decode(x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the count and digests of its ids, and of the bytes decoded from those ids."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranks = load_ranks(path)
        ids, rows = encode_block(*byte_buffer(batch.column("text")), ranks.encode)
        ids = ids.astype("<u4")
        count, sha_ids, sha_bytes = [], [], []
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            own = ids[a:b]
            count.append(b - a)
            sha_ids.append(hashlib.sha256(own.tobytes()).hexdigest())
            sha_bytes.append(hashlib.sha256(ranks.decode(own.tolist())).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(sha_ids, pa.string()), pa.array(sha_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_blocks(texts(docs), block, DIGEST)
