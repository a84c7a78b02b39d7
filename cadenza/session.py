"""Session helpers.

The library never builds its own session inside an operator: operators take
DataFrames. These helpers exist for tests, the bench and the entry module.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours needs for results to be reproducible:
# UTC so epoch-second conversions match the SQL oracle (trap T17), AQE on so
# skewed joins/aggregations are re-planned at run time.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cadenza") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CADENZA_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_NO_FOLDER = "set spark.checkpoint.dir to a folder that the driver and all executors share"


def _one_machine(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``), which share every folder."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local session (one machine) without that setting gets a scratch
    folder, deleted when Python ends; any other session without it fails.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Connect session has no SparkContext: the setting must be there
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError(_NO_FOLDER) from None
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not configured:
        if not _one_machine(sc.master):
            raise RuntimeError(_NO_FOLDER)
        configured = tempfile.mkdtemp(prefix="cadenza-ckpt-", dir=os.environ.get("CADENZA_SCRATCH", "/tmp"))
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage (later stages read files on shared storage, so a lost
    executor does not force the upstream plan to re-run) and keeps later plans
    small. Parquet is used rather than ``Dataset.checkpoint`` because it is
    columnar, compressed and written in one job.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/cadenza-table-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._materialized_at = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` wrote and that no plan will read any more (others and None are left alone)."""
    for df in tables:
        path = getattr(df, "_materialized_at", None)
        if path is not None:
            discard(df.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that was written under the checkpoint folder and that no plan will read any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


@contextlib.contextmanager
def spent_shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each write or collect go when it ends, instead of when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20, cores: int | None = None) -> dict[str, str]:
    """Settings to size shuffles for an input of ``input_bytes`` (e.g. 100 TB).

    Shuffle partitions start at about input / target (AQE coalesces small ones
    and splits skewed ones at run time), but never below twice the cores, so
    every core has work. Scan splits and AQE's advisory size use the same
    target, which keeps each task's state well inside executor memory.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    if cores:
        partitions = max(partitions, 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
