"""Token ids in patched frame-of-reference (PFOR) files.

A chunk holds the ids of consecutive documents. Its payload is::

    magic "PFR1" | n_ids u32 | n_blocks u32 | block starts u32[n_blocks + 1] | blocks
    block: minimum u32 | width u8 | n_exceptions u16 | packed | places u16[] | values u32[]

all little-endian. A block of ``BLOCK`` ids stores each id minus the block's
minimum, its low ``width`` bits packed; ``width`` covers the ``PERCENTILE``
of the block. The outliers' whole differences stand in the exception list.
The starts let a reader open one block alone (``read_block``).

Chunks are rows of a Parquet table (part, first, doc_ids, counts, payload),
so any store that Spark can write holds them. ``part`` numbers range
partitions of ascending doc_id; ``first`` counts the ids before the chunk in
its part. Only one total per part reaches the driver.

Defined results: null and empty texts have the end id alone; of repeated
doc_ids the smaller text comes first; null doc_ids come first; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import uuid
import zlib
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.bpe import SliceCache, encode_block
from cadenza.llm.common import blocks, byte_buffer, ship, texts
from cadenza.session import ensure_checkpoint_dir

BLOCK = 1024
PERCENTILE = 0.9
MAGIC = b"PFR1"
END_ID = 0
#: A chunk is closed at so many ids (one longer document stays whole).
CHUNK_IDS = 1 << 18
#: Distinct slices kept by one worker.
CACHE_SLICES = 1 << 20

CHUNKS = "part int, first bigint, doc_ids array<bigint>, counts array<bigint>, payload binary"


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _pack(x: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each number of each row, packed: uint8 (rows, bytes)."""
    bits = np.unpackbits(np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(*x.shape, 4), axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(x), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros((len(packed), BLOCK, 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(packed, axis=1, count=BLOCK * width, bitorder="little").reshape(len(packed), BLOCK, width)
    return np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]


def pack_ids(ids: np.ndarray) -> bytes:
    """The payload of a chunk."""
    n = len(ids)
    count = -(-n // BLOCK)
    rows = np.empty(count * BLOCK, np.uint32)
    rows[:n] = ids
    if n % BLOCK:
        rows[n:] = rows[(count - 1) * BLOCK : n].min()
    rows = rows.reshape(count, BLOCK)
    low = rows.min(axis=1) if count else np.zeros(0, np.uint32)
    rows = rows - low[:, None]
    kth = int(PERCENTILE * (BLOCK - 1))
    widths = _bit_lengths(np.partition(rows, kth, axis=1)[:, kth]) if count else np.zeros(0, np.int64)
    packed: list = [b""] * count
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        for i, line in zip(own.tolist(), _pack(rows[own], width)):
            packed[i] = line.tobytes()
    over = rows >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    at, place = np.nonzero(over)
    value = rows[at, place].astype("<u4")
    cut = np.searchsorted(at, np.arange(count + 1))
    out = []
    for i in range(count):
        a, b = int(cut[i]), int(cut[i + 1])
        out.append(int(low[i]).to_bytes(4, "little") + int(widths[i]).to_bytes(1, "little") + (b - a).to_bytes(2, "little") + packed[i] + place[a:b].astype("<u2").tobytes() + value[a:b].tobytes())
    starts = np.array([0, *accumulate(map(len, out))], "<u4")
    return b"".join([MAGIC, n.to_bytes(4, "little"), count.to_bytes(4, "little"), starts.tobytes(), *out])


def _header(payload: bytes) -> tuple[int, np.ndarray, int]:
    if payload[:4] != MAGIC:
        raise ValueError("not a PFOR payload")
    n, count = int.from_bytes(payload[4:8], "little"), int.from_bytes(payload[8:12], "little")
    return n, np.frombuffer(payload, "<u4", count + 1, 12), 12 + 4 * (count + 1)


def _decode(payload: bytes, offsets: list[int]) -> np.ndarray:
    """Whole blocks that begin at these bytes: uint32 (blocks, BLOCK)."""
    rows = np.empty((len(offsets), BLOCK), np.uint32)
    widths = np.array([payload[o + 4] for o in offsets], np.int64)
    data = np.frombuffer(payload, np.uint8)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        size = BLOCK * width // 8
        rows[own] = _unpack(np.stack([data[offsets[i] + 7 : offsets[i] + 7 + size] for i in own.tolist()]), width)
    for i, o in enumerate(offsets):
        if extra := int.from_bytes(payload[o + 5 : o + 7], "little"):
            at = o + 7 + BLOCK * int(widths[i]) // 8
            rows[i, np.frombuffer(payload, "<u2", extra, at)] = np.frombuffer(payload, "<u4", extra, at + 2 * extra)
        rows[i] += np.uint32(int.from_bytes(payload[o : o + 4], "little"))
    return rows


def unpack_ids(payload: bytes) -> np.ndarray:
    """All ids of a chunk."""
    n, starts, base = _header(payload)
    return _decode(payload, [base + s for s in starts[:-1].tolist()]).reshape(-1)[:n]


def read_block(payload: bytes, k: int) -> np.ndarray:
    """The ids of block ``k`` alone, by the index."""
    n, starts, base = _header(payload)
    return _decode(payload, [base + int(starts[k])])[0][: n - k * BLOCK]


class LibraryEncoder:
    """The tokenizer of a ``tokenizers`` file; the library's model encodes each distinct slice once.

    ``added``: the file's added tokens are matched in the texts, as by the
    library's ``encode`` (whose ``encode_special_tokens`` is then False).
    """

    def __init__(self, path: str, added: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(own)]
        self.shown = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.cache = SliceCache(CACHE_SLICES)

    def _library(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, shown = self.tokenizer.model.tokenize, self.shown
        ids = [[t.id for t in tokenize(p.decode("latin-1").translate(shown))] for p in pieces]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.cache.encode(pieces, self._library)

    def encode_texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, end to end, and the n + 1 row offsets; texts that hold an added token go to the library whole."""
        marked = np.zeros(len(column), bool)
        for mark in self.marks:
            # A token may match more than its content (blanks beside it, another case), never without it.
            marked |= pc.match_substring(column, mark, ignore_case=True).to_numpy(zero_copy_only=False)
        if not marked.any():
            return encode_block(*byte_buffer(column), self.encode)
        ids, rows = encode_block(*byte_buffer(pc.if_else(pa.array(marked), "", column)), self.encode)
        own = [ids[a:b] for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]
        for i in np.flatnonzero(marked).tolist():
            own[i] = np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(own), np.append(0, np.cumsum([len(x) for x in own]))


@lru_cache(maxsize=2)
def load_encoder(path: str, added: bool = False) -> LibraryEncoder:
    return LibraryEncoder(path, added)


def write_ids(docs: DataFrame, path: str, out: str, end_id: int = END_ID, added: bool = False) -> None:
    """Encode ``docs`` in ascending doc_id order and write the chunks to ``out``."""
    ship(docs.sparkSession)

    def run(batches):
        part, first = TaskContext.get().partitionId(), 0
        encoder = load_encoder(path, added)
        held, doc_ids, counts, total = [], [], [], 0

        def close():
            nonlocal held, doc_ids, counts, total, first
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([pack_ids(np.concatenate(held))], pa.binary())],
                ["part", "first", "doc_ids", "counts", "payload"],
            )
            first += total
            held, doc_ids, counts, total = [], [], [], 0
            return row

        for batch in batches:
            for block in blocks(batch):
                ids, rows = encoder.encode_texts(block.column("text"))
                own = np.diff(rows)
                # The end id follows the ids of each document.
                held.append(np.insert(ids, rows[1:], end_id).astype(np.uint32))
                doc_ids += block.column("doc_id").to_pylist()
                counts += (own + 1).tolist()
                total += len(ids) + len(own)
                if total >= CHUNK_IDS:
                    yield close()
        if doc_ids:
            yield close()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, CHUNKS).write.mode("overwrite").parquet(out)


def read_digests(chunks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the written chunks."""
    spark = chunks.sparkSession
    ship(spark)
    totals = chunks.select("part", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = dict(zip([r["part"] for r in totals], accumulate([0, *[r["n"] for r in totals]])))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["payload"]).astype("<u4")
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                start = before[row["part"]] + row["first"] + ends - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return chunks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(chunks: DataFrame) -> DataFrame:
    """``doc_id, ids`` (with the end id) from the written chunks."""
    ship(chunks.sparkSession)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["payload"])
                offsets = np.append(0, np.cumsum(row["counts"])).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return chunks.mapInArrow(run, "doc_id bigint, ids array<int>")


def token_files(docs: DataFrame, path: str, out: str | None = None, added: bool = False) -> DataFrame:
    """Write the files of ``docs`` (below the shared checkpoint folder unless told where) and return the chunks read back; ``added`` as in ``LibraryEncoder``."""
    spark = docs.sparkSession
    out = out or f"{ensure_checkpoint_dir(spark).rstrip('/')}/pfor-{uuid.uuid4().hex}"
    write_ids(docs, path, out, added=added)
    return spark.read.schema(CHUNKS).parquet(out)
