"""Array kernels over a block of texts: word boundaries, hashes of slices, segments.

A block is one byte buffer with row offsets (see ``common.byte_buffer``).
Equal byte strings have equal hashes on every worker.
"""

from __future__ import annotations

import numpy as np
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer slices are hashed one by one.
LONG_BYTES = 512

#: Byte classes of the two word definitions in use.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte slices ``data[start:end]``.

    Eight bytes at a time pass through the finaliser, so the hash isn't linear
    in the bytes modulo a power of two (a polynomial there gives equal hashes
    to long words of two letters and their complements). Slices of over
    ``LONG_BYTES`` are hashed one by one.
    """
    starts, lengths = np.asarray(starts, np.int64), np.asarray(ends - starts, np.int64)
    h = mix(lengths.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 + seed))
    room = np.zeros(len(data) + 8, np.uint8)
    room[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", room, strides=(1,))
    long = lengths > LONG_BYTES
    for i in np.flatnonzero(long).tolist():
        h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(room[starts[i] : starts[i] + lengths[i]], seed))
    which = np.flatnonzero((lengths > 0) & ~long)
    at, left = starts[which], lengths[which]
    while len(which):
        h[which] = mix(h[which] * _P ^ (eights[at] & _LOW_BYTES[np.minimum(left, 8)]))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return mix(h)


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends of the runs of word bytes, which stop at row ends, and n + 1 row offsets into them."""
    mask = word[data]
    before = np.empty(len(mask), bool)
    before[:1] = False
    before[1:] = mask[:-1]
    inner = offsets[offsets < len(mask)]
    before[inner] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(len(mask), bool)
    after[-1:] = False
    after[:-1] = mask[1:]
    after[offsets[offsets > 0] - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive word hashes in each row, and n + 1 row offsets.

    A row of fewer words, but not none, has one shingle: the whole sequence.
    """
    n = np.diff(rows)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=out[1:])
    first = np.repeat(rows[:-1] - out[:-1], count) + np.arange(out[-1])
    width = np.repeat(np.minimum(n, size), count)
    h = np.zeros(int(out[-1]), np.uint64)
    for k in range(size):
        use = k < width
        if use.all():
            h = mix(h * _P + words[first + k])
        else:
            h[use] = mix(h[use] * _P + words[first[use] + k])
    return h ^ width.astype(np.uint64), out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``concatenate([arange(s, s + n) for s, n in zip(starts, lengths)])``."""
    total = np.cumsum(lengths)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (total - lengths), lengths) + np.arange(total[-1])
