"""Shared helpers: reading documents, Arrow batches, worker imports.

All operators take ``doc_id`` and ``text`` by name and drop every other column
first, so extra columns, also with clashing names, never reach a join.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text bytes handled at once inside a task (one longer text is handled alone).
BLOCK_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or passed with ``--py-files``; this
    covers local sessions started in another folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (null: empty), nothing else."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has such a column (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and n + 1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if not n or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch of about ``limit`` text bytes each."""
    _, offsets = byte_buffer(batch.column(batch.schema.get_field_index(text)))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def map_blocks(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text") -> DataFrame:
    """``mapInArrow`` over blocks of about ``BLOCK_BYTES`` of ``text``: memory is bounded by a block."""
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            for block in blocks(batch, text):
                out = fn(block)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def filter_blocks(df: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray], text: str = "text") -> DataFrame:
    """The rows of ``df``, with all its columns, that ``keep`` marks in each block."""
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            for block in blocks(batch, text):
                out = block.filter(pa.array(keep(block), pa.bool_()))
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, df.schema)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the doc_id as text, modulo n (null: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


#: Parts that the ids of a label are ranked in before they are ranked together.
SAMPLE_PARTS = 64


def sample_rows(docs: DataFrame, labelled: DataFrame, per_label: int, label_of: Column | None = None) -> DataFrame:
    """``doc_id, label, text`` of at most ``per_label`` doc_ids of each label, by a hash of doc_id.

    ``labelled`` has doc_id and label; null labels and texts are left out. Of
    a repeated doc_id the smallest label counts, and the smallest of its texts;
    where the labels stand in ``docs`` (``label_of``), of the rows with that
    label. Ids are ranked in parts first, so no task ranks all ids of a label.
    """
    rows = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), "label").dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    rows = rows.withColumns({"h": F.xxhash64("doc_id"), "part": F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(SAMPLE_PARTS))})
    for keys in (["label", "part"], ["label"]):
        order = Window.partitionBy(*keys).orderBy("h", "doc_id")
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label)
    chosen = rows.select("doc_id", "label")
    own = docs.where(F.col("text").isNotNull())
    found = texts(own) if label_of is None else own.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), label_of.alias("label"))
    # At most per_label rows of each label.
    joined = found.join(F.broadcast(chosen), "doc_id" if label_of is None else ["doc_id", "label"])
    return joined.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def labelled_sample(docs: DataFrame, labelled: DataFrame, per_label: int, label_of: Column | None = None) -> list[tuple[str, object]]:
    """``sample_rows`` as (text, label), by ascending doc_id."""
    return [(r["text"], r["label"]) for r in sorted(sample_rows(docs, labelled, per_label, label_of).collect(), key=lambda r: r["doc_id"])]
