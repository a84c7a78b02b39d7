"""The incremental ingest stores each key once, across batches and reruns."""

from __future__ import annotations

from pyspark.sql import types as T

from cadenza.session import scale_settings
from cadenza.streaming.ingest import BUCKET, ingest_json_batches, new_records, read_ingested

SCHEMA = T.StructType([T.StructField("uri", T.StringType()), T.StructField("v", T.DoubleType())])


def test_ingest_is_idempotent_across_batches_and_reruns(spark, tmp_path):
    src, target, ckpt = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    first = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0)], SCHEMA)
    first.write.mode("append").json(src)
    ingest_json_batches(spark, src, SCHEMA, target, ckpt, key="uri")
    assert sorted(r.uri for r in spark.read.parquet(target).collect()) == ["a", "b"]

    # A later batch repeats a key and brings a new one; a rerun sees no new file.
    spark.createDataFrame([("b", 2.0), ("c", 3.0)], SCHEMA).write.mode("append").json(src)
    ingest_json_batches(spark, src, SCHEMA, target, ckpt, key="uri")
    ingest_json_batches(spark, src, SCHEMA, target, ckpt, key="uri")
    assert sorted(r.uri for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_scale_settings_grow_with_input():
    small = scale_settings(10 << 30)
    huge = scale_settings(100 << 40, cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(huge["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


def test_a_batch_reads_its_own_partitions_and_a_rerun_adds_nothing(spark, tmp_path):
    src, target, ckpt = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    spark.createDataFrame([(f"k{i}", float(i)) for i in range(300)], SCHEMA).write.mode("append").json(src)
    ingest_json_batches(spark, src, SCHEMA, target, ckpt, key="uri", buckets=64)
    assert read_ingested(spark, target, SCHEMA).count() == 300
    batch = spark.createDataFrame([("k7", 7.0), ("new", 1.0), ("new", 2.0)], SCHEMA)
    rows = new_records(batch, target, "uri", 64)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [tuple(r)[:2] for r in rows.collect()] == [("new", 2.0)]
    # As after a batch that failed once it had written: the same batch again.
    rows.write.mode("append").partitionBy(BUCKET).parquet(target)
    assert new_records(batch, target, "uri", 64).count() == 0
    assert read_ingested(spark, target, SCHEMA).count() == 301
