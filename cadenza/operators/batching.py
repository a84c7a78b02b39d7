"""Distinct item ids, sorted, cut into request batches, comma-joined.

The reference collects every id to the driver, sorts there and loops; here
the sort position comes from ``with_row_index`` and each batch is one group
of at most ``batch_size`` ids. The last, partial batch is kept (trap T13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scalar import uri_to_id
from cadenza.operators.indexing import with_row_index


def distinct_ids(occurrences: DataFrame, uri_col: str = "track_uri") -> DataFrame:
    """P4 + X3: distinct ids (text after the last ':') of a uri column."""
    return occurrences.select(uri_to_id(uri_col).alias("id")).distinct()


def id_batches(ids: DataFrame, batch_size: int = 100, batches_per_file: int = 100, id_col: str = "id") -> DataFrame:
    """(batch, file, n_ids, ids): ids in sorted order, ``batch_size`` per batch.

    ``file`` groups ``batches_per_file`` consecutive batches, as the reference
    stores its results every 100 batches.
    """
    indexed = with_row_index(ids.select(id_col), [F.col(id_col)], "idx")
    batched = indexed.withColumn("batch", F.floor(F.col("idx") / batch_size))
    return batched.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_ids"),
        # Sorting the (at most batch_size) ids again gives the global order back.
        F.array_join(F.array_sort(F.collect_list(id_col)), ",").alias("ids"),
    ).select("batch", F.floor(F.col("batch") / batches_per_file).alias("file"), "n_ids", "ids")
