"""Spark session helpers.

Jobs never hard-code machine-local folders: shared locations (checkpoints,
written intermediate tables) come from the session's ``spark.checkpoint.dir``.
Only local-mode runs fall back to a scratch folder when it is unset; on a
cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "staylens") -> SparkSession:
    """A local session for tests and the bench (the cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Wide projections (70+ listing columns) fuse into one generated method;
        # above HotSpot's 8000-byte JIT limit it would run interpreted, so such a
        # stage falls back to per-operator codegen instead (Spark's documented setting).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("STAYLENS_DRIVER_MEMORY", _driver_memory()))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _driver_memory() -> str:
    """Local-mode heap: 60 % of physical memory, between 1 and 8 GiB."""
    try:
        with open("/proc/meminfo") as f:
            kb = int(next(ln for ln in f if ln.startswith("MemTotal")).split()[1])
        mb = int(kb / 1024 * 0.6)
    except (OSError, StopIteration, ValueError):
        mb = 4096
    return f"{max(1024, min(8192, mb))}m"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="staylens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go as soon as the query ends, not when the driver next
    collects garbage: steps that write their tables one after the other hold only one step's."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def narrow_codegen(spark: SparkSession) -> None:
    """Wide projections (70+ listing columns) fuse into a method above HotSpot's JIT limit of 8000 bytes and would
    run interpreted: such a stage falls back to code of its own for each operator."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scale_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.1,
               partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Runtime SQL settings sized for a cluster run.

    * scan splits of ``partition_bytes`` (column pruning makes the bytes read
      smaller than the files, so splits stay well inside executor memory);
    * initial shuffle partitions from the expected shuffle volume (input x
      ``shuffle_fraction``: projection and map-side partial aggregation shrink
      it) at ``partition_bytes`` each, at least two waves of tasks; AQE then
      coalesces small partitions and splits skewed ones;
    * broadcast only what AQE measured below the threshold at runtime.
    """
    shuffle_parts = max(2 * total_cores, int(input_bytes * shuffle_fraction // partition_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
