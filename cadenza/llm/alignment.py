"""Alignment of two tokenizers by pointer jumping.

Tokenizer A (a byte-level ``tokenizers`` file) takes a space and the text,
tokenizer B (a ``sentencepiece`` model) the text, which it puts a space before
by itself. Each token covers a range of the bytes of space+text. Byte offsets
at which tokens of both sides end cut the tokens into groups.

Every token points to its farthest-right overlapping token: a token of A to
the token of B that covers its last byte, a token of B to the token of A that
covers its last byte if that one reaches further, else to itself. Successor
doubling, ``s = s[s]`` over all tokens of a block at once until nothing moves,
leads each token to the terminal token of its component, and that labels its
group. Links are the overlapping pairs, one for each distinct end of a token.

The count of an id pair is the number of documents that hold it linked. Tasks
gather documents into regions of about ``REGION_LINKS`` links and write each
region's distinct pairs with their document counts; sums per pair, and the
highest sum per A id (at most one row per id of A's vocabulary), go back to
the regions by a join on the pair. A pair has one row per region at most, so a
pair that every document holds is spread thin, and no row per link leaves a
task. A region is met by its counts in a co-group bounded by the region.

Defined results: null and empty texts, and texts whose joined tokens of a side
differ from space+text (the other side normalises or can't express a
character), have no tokens; repeated rows count as documents of their own; a
null doc_id is kept; an empty table gives an empty result; other columns are
dropped. A text longer than a block is handled alone and whole.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import kernels as K
from cadenza.llm.bpe import SliceCache, distinct_slices
from cadenza.llm.common import blocks, byte_buffer, map_blocks, ship, texts
from cadenza.llm.pfor import LibraryEncoder
from cadenza.session import materialize

#: A region closes at so many links (a longer document stays whole).
REGION_LINKS = 1 << 20
#: Distinct slices of each side kept by one worker.
CACHE_SLICES = 1 << 18
#: Rows of a region's pair table handed on at once.
PAIR_ROWS = 1 << 16


class Pieces:
    """The bytes of each id of a vocabulary, end to end."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def equal(self, ids: np.ndarray, rows: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which rows' joined token bytes are their bytes in ``data``."""
        ends = np.append(0, np.cumsum(self.lengths[ids]))[rows]
        same = np.diff(ends) == np.diff(offsets)
        own = np.repeat(same, np.diff(rows))
        flat = self.data[K.ranges(self.starts[ids[own]], self.lengths[ids[own]])]
        n = np.diff(offsets)[same]
        wrong = np.append(0, np.cumsum(flat != data[K.ranges(offsets[:-1][same], n)]))
        cut = np.append(0, np.cumsum(n))
        same[same] = wrong[cut[1:]] == wrong[cut[:-1]]
        return same


class Sides:
    """Both tokenizers, loaded once per worker."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a = LibraryEncoder(a_path)
        self.a.cache = SliceCache(CACHE_SLICES)
        values = {c: b for b, c in self.a.shown.items()}
        vocabulary = self.a.tokenizer.get_vocab()
        a_pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            a_pieces[i] = bytes(values[c] for c in piece) if all(c in values for c in piece) else piece.encode()
        self.a_pieces = Pieces(a_pieces)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_pieces = Pieces([self._b_bytes(i) for i in range(self.b.get_piece_size())])
        # No piece goes on to a space after another character, so no merge crosses the place before a space.
        self.by_words = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.cache = SliceCache(CACHE_SLICES)
        names = [str(i) for i in range(max(len(a_pieces), self.b.get_piece_size()))]
        self.name_lengths = np.array([len(x) for x in names], np.int64)
        self.names = np.zeros((len(names), len(names[-1]) + 1), np.uint8)
        for i, x in enumerate(names):
            self.names[i, : len(x)] = np.frombuffer(x.encode(), np.uint8)

    def _b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts the first space before a text, but none where nothing follows.
        lists = self.b.encode([w[1:].decode() for w in words], num_threads=1)
        space = self.b.piece_to_id("▁")
        lists = [x if len(w) > 1 else [space] for x, w in zip(lists, words)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts

    def b_tokens(self, column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of B, end to end, and the n + 1 row offsets; ``data`` has the spaced texts.

        Each distinct word, which is spaces and what follows up to the next space, goes to the library once.
        Only a text that holds "▁" itself may get other ids so, and that has no tokens: its bytes come back as a space.
        """
        if not self.by_words:
            lists = self.b.encode(column.to_pylist(), num_threads=1)
            rows = np.append(0, np.cumsum([len(x) for x in lists], dtype=np.int64))
            return np.fromiter(chain.from_iterable(lists), np.uint32, int(rows[-1])), rows
        begin = np.zeros(len(data), bool)
        space = data == 0x20
        begin[1:] = space[1:] & ~space[:-1]
        begin[offsets[:-1]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        first, which = distinct_slices(data, starts, ends)
        raw = data.tobytes()
        pool, sizes = self.cache.encode([raw[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())], self._library)
        at = np.cumsum(sizes) - sizes
        total = np.append(0, np.cumsum(sizes[which]))
        return pool[K.ranges(at[which], sizes[which])], total[np.searchsorted(starts, offsets)]

    def tokens(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, n + 1 row offsets, ids of B, row offsets, and which rows have tokens; the others have none."""
        spaced = pc.binary_join_element_wise(pa.scalar("", column.type), column, pa.scalar(" ", column.type))
        data, offsets = byte_buffer(spaced)
        a, a_rows = self.a.encode_texts(spaced)
        b, b_rows = self.b_tokens(column, data, offsets)
        used = np.diff(offsets) > 1
        used &= self.a_pieces.equal(a, a_rows, data, offsets) & self.b_pieces.equal(b, b_rows, data, offsets)
        out = []
        for ids, rows in ((a, a_rows), (b, b_rows)):
            n = np.where(used, np.diff(rows), 0)
            out += [ids[np.repeat(used, np.diff(rows))], np.append(0, np.cumsum(n))]
        return (*out, used)


@lru_cache(maxsize=2)
def load_sides(a_path: str, b_path: str) -> Sides:
    return Sides(a_path, b_path)


def _ends_below(ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the ends among the places 0 .. size, and how many lie below each place."""
    mark = np.zeros(size + 1, bool)
    mark[ends] = True
    below = np.zeros(size + 2, np.int32)
    np.cumsum(mark, out=below[1:])
    return mark, below[:-1]


def label_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, numbered from 0, by pointer jumping over the ends of tokens that tile the same bytes."""
    na, nb = len(a_ends), len(b_ends)
    last, back = _ends_below(b_ends, a_ends[-1])[1][a_ends], _ends_below(a_ends, a_ends[-1])[1][b_ends]
    s = np.concatenate([na + last, np.where(a_ends[back] > b_ends, back, na + np.arange(nb))])
    while True:
        further = s[s]
        if np.array_equal(further, s):
            break
        s = further
    number = np.cumsum(s[na:] == na + np.arange(nb)) - 1
    return number[s[:na] - na], number[s[na:] - na]


class Block:
    """The alignment of a block of texts."""

    def __init__(self, sides: Sides, column: pa.Array) -> None:
        self.a, self.a_rows, self.b, self.b_rows, self.used = sides.tokens(column)
        a_ends, b_ends = np.cumsum(sides.a_pieces.lengths[self.a]), np.cumsum(sides.b_pieces.lengths[self.b])
        if not len(self.a):
            none = np.zeros(0, np.int64)
            self.a_group = self.b_group = self.link_a = self.link_b = none
            self.group_rows = self.link_rows = np.zeros(len(self.a_rows), np.int64)
            return
        self.a_group, self.b_group = label_groups(a_ends, b_ends)
        # The last byte of a row is the end of a group, so rows cut the groups as well.
        self.group_rows = np.append(0, self.b_group + 1)[self.b_rows]
        (is_a, a_below), (is_b, b_below) = (_ends_below(x, a_ends[-1]) for x in (a_ends, b_ends))
        ends = np.flatnonzero(is_a | is_b)
        self.link_a, self.link_b = a_below[ends], b_below[ends]
        self.link_rows = np.searchsorted(ends, np.append(0, a_ends)[self.a_rows], "right")

    def pairs(self) -> np.ndarray:
        """The id pair of each link: A's id above, B's in the lower 32 bits."""
        return self.a[self.link_a].astype(np.int64) << 32 | self.b[self.link_b].astype(np.int64)

    def group_digests(self, sides: Sides) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` of each row (no tokens: an empty string)."""
        na, nb = len(self.a), len(self.b)
        n = int(self.group_rows[-1])
        in_a, in_b = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        at_a = np.arange(na) + (np.cumsum(in_b) - in_b)[self.a_group]
        at_b = np.arange(nb) + np.cumsum(in_a)[self.b_group]
        ids, mark = np.empty(na + nb, np.int64), np.empty(na + nb, np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        more = lambda g: np.append(g[1:] == g[:-1], False)[: len(g)]
        mark[at_a] = np.where(more(self.a_group), ord(","), ord("|"))
        mark[at_b] = np.where(more(self.b_group), ord(","), ord(";"))
        rows = self.a_rows + self.b_rows
        lengths = sides.name_lengths[ids]
        text = sides.names[ids]
        text[np.arange(na + nb), lengths] = mark
        size = lengths + 1
        last = rows[1:][self.used] - 1
        size[last] -= 1  # no mark behind a row's last token
        flat = text[np.arange(text.shape[1]) < size[:, None]].tobytes()
        cut = np.append(0, np.cumsum(size))[rows].tolist()
        return [hashlib.sha256(flat[i:j]).hexdigest() if j > i else "" for i, j in zip(cut[:-1], cut[1:])]


ALIGNED = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>"


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id``, the ids of both sides and the group of each token, numbered from 0 in a document."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Block(load_sides(a_path, b_path), batch.column("text"))
        out = [batch.column("doc_id")]
        for values, rows in ((own.a, own.a_rows), (own.b, own.b_rows)):
            out.append(pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(values.astype(np.int32))))
        for values, rows in ((own.a_group, own.a_rows), (own.b_group, own.b_rows)):
            first = np.repeat(own.group_rows[:-1], np.diff(rows))
            out.append(pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array((values - first).astype(np.int32))))
        return pa.RecordBatch.from_arrays(out, ["doc_id", "a_ids", "b_ids", "a_groups", "b_groups"])

    return map_blocks(texts(docs), block, ALIGNED)


REGIONS = (
    "region bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
    "pairs binary, holders binary, entry_rows binary, entry_pairs binary, entry_links binary"
)


def regions(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per region: per document its figures and its distinct pairs (``entry_*``), and the region's distinct pairs with the number of documents that hold them."""
    ship(docs.sparkSession)

    def run(batches):
        sides, part, made = load_sides(a_path, b_path), TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        links = 0

        def close() -> pa.RecordBatch:
            nonlocal held, links, made
            columns = [list(chain.from_iterable(x)) for x in zip(*[h[:6] for h in held])]
            n_links = np.array(columns[4], np.int64)
            pairs, local = np.unique(np.concatenate([h[6] for h in held]), return_inverse=True)
            document = np.repeat(np.arange(len(n_links)), n_links)
            entries, times = np.unique(document * max(len(pairs), 1) + local, return_counts=True)
            document, local = np.divmod(entries, max(len(pairs), 1))
            rows = np.searchsorted(document, np.arange(len(n_links) + 1))
            arrays = (pairs.astype("<i8"), np.bincount(local, minlength=len(pairs)).astype("<i8"), rows.astype("<i8"), local.astype("<u4"), times.astype("<u4"))
            values = [part << 33 | made, *columns, *[x.tobytes() for x in arrays]]
            types = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.binary()] * 5]
            held, links, made = [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [c.split()[0] for c in REGIONS.split(", ")])

        for batch in batches:
            for block in blocks(batch):
                own = Block(sides, block.column("text"))
                counts = [np.diff(x).tolist() for x in (own.a_rows, own.b_rows, own.group_rows, own.link_rows)]
                held.append((block.column("doc_id").to_pylist(), *counts, own.group_digests(sides), own.pairs()))
                links += len(own.link_a)
                if links >= REGION_LINKS:
                    yield close()
        if held:
            yield close()

    return texts(docs).mapInArrow(run, REGIONS)


def region_pairs(table: DataFrame) -> DataFrame:
    """``region, place, pair, holders``: a row per distinct pair of a region."""
    ship(table.sparkSession)
    names = ["region", "place", "pair", "holders"]

    def run(batches):
        load_sides.cache_clear()  # a worker that made regions before holds tokenizers and caches, which no later step needs
        for batch in batches:
            for region, pairs, holders in zip(*(batch.column(i).to_pylist() for i in range(3))):
                pairs, holders = np.frombuffer(pairs, "<i8"), np.frombuffer(holders, "<i8")
                for i in range(0, len(pairs), PAIR_ROWS):
                    own = pairs[i : i + PAIR_ROWS]
                    place = np.arange(i, i + len(own), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), region)), pa.array(place), pa.array(own), pa.array(holders[i : i + PAIR_ROWS])], names)

    return table.select("region", "pairs", "holders").mapInArrow(run, "region bigint, place int, pair bigint, holders bigint")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many documents each pair is linked, and whether that is the highest of its A id."""
    counts = materialize(pairs.groupBy("pair").agg(F.sum("holders").alias("n")))
    top = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("top"))
    # One row per id of A's vocabulary at most.
    return counts.join(F.broadcast(top), F.shiftright(counts["pair"], 32) == top["a"]).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


OUT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def alignment_digests(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document the figures of its alignment, the sums over its links of the corpus-wide pair counts, and the digest of its groups."""
    table = materialize(regions(docs, a_path, b_path))
    pairs = region_pairs(table)
    values = pairs.select("region", "place", "pair").join(pair_counts(pairs), "pair").select("region", "place", "n", "best")

    def region(own: pa.Table, counted: pa.Table) -> pa.Table:
        load_sides.cache_clear()
        if not own.num_rows:
            return pa.table({c.split()[0]: pa.array([], pa.string() if c.endswith("string") else pa.int64()) for c in OUT.split(", ")})
        row = own.to_pylist()[0]
        place = counted.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = counted.column("n").to_numpy()
        best[place] = counted.column("best").to_numpy(zero_copy_only=False)
        rows, entry, times = (np.frombuffer(row[f"entry_{k}"], t) for k, t in (("rows", "<i8"), ("pairs", "<u4"), ("links", "<u4")))
        times = times.astype(np.int64)
        total = lambda x: np.diff(np.append(0, np.cumsum(x[entry] * times))[rows])
        out = {c: pa.array(row[c], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": total(best), "count_sum": total(count), "groups_sha256": pa.array(row["groups_sha256"], pa.string())})

    kept = table.drop("pairs", "holders")
    return kept.groupBy("region").cogroup(values.groupBy("region")).applyInArrow(region, OUT)
