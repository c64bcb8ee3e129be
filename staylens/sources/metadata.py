"""Pipeline metadata as append-only event tables (SNK-4, SNK-5, SRC-6, AGG-15, WIN-7).

The source keeps a small database with sequences and UPDATEs. Here both
tables are append-only Parquet event logs with explicit schemas; the current
state of a run is its latest event (``max_by`` per run id), so no UPDATE and
no single writer are needed, and a retried task cannot corrupt state.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

INGESTION_LOG = StructType([
    StructField("log_id", StringType(), False),
    StructField("city", StringType(), False),
    StructField("layer", StringType(), False),
    StructField("file_name", StringType(), False),
    StructField("source_url", StringType(), True),
    StructField("file_path", StringType(), True),
    StructField("ingested_at", TimestampType(), False),
    StructField("row_count", LongType(), True),
    StructField("file_size_mb", DoubleType(), True),
    StructField("status", StringType(), False),
    StructField("error_message", StringType(), True),
    StructField("duration_sec", DoubleType(), True),
])

PIPELINE_RUNS = StructType([
    StructField("run_id", StringType(), False),
    StructField("city", StringType(), False),
    StructField("event_at", TimestampType(), False),
    StructField("phases", StringType(), True),
    StructField("status", StringType(), False),
    StructField("error_message", StringType(), True),
])


PHASE_RUNS = StructType([
    StructField("run_id", StringType(), False),
    StructField("city", StringType(), False),
    StructField("phase", StringType(), False),
    StructField("fingerprint", StringType(), False),
    StructField("status", StringType(), False),
    StructField("event_at", TimestampType(), False),
])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def event(city: str, layer: str, file_name: str, status: str, source_url=None, file_path=None, row_count=None,
          file_size_mb=None, error_message=None, duration_sec=None) -> tuple:
    return (uuid.uuid4().hex, city, layer, file_name, source_url, file_path, _now(), row_count, file_size_mb, status,
            error_message, duration_sec)


def append_events(spark: SparkSession, log_path: str, events: list[tuple]) -> None:
    """SNK-4: one batch append per phase."""
    if events:
        spark.createDataFrame(events, INGESTION_LOG).write.mode("append").parquet(log_path)


def append_frame(events: DataFrame, log_path: str) -> None:
    """SNK-4 for events computed as a DataFrame (no driver round trip)."""
    events.select(*[F.col(f.name).cast(f.dataType) for f in INGESTION_LOG.fields]).write.mode("append").parquet(log_path)


def _read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``; empty if nothing was written yet. Any other error is raised:
    an unreadable log must not look like an empty one (everything would be ingested again)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return _read_or_empty(spark, log_path, INGESTION_LOG)


def new_run_id() -> str:
    return f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"


def run_event(spark: SparkSession, runs_path: str, run_id: str, city: str, phases: list[str], status: str,
              error_message: str | None = None) -> None:
    """SNK-5: a run is a start event (``running``) and a finish event."""
    row = (run_id, city, _now(), ",".join(phases), status, error_message)
    spark.createDataFrame([row], PIPELINE_RUNS).write.mode("append").parquet(runs_path)


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    return _read_or_empty(spark, runs_path, PIPELINE_RUNS)


def phase_event(spark: SparkSession, path: str, run_id: str, city: str, phase: str, fingerprint: str, status: str) -> None:
    """What a phase of a run was built from, and how it ended (append-only)."""
    spark.createDataFrame([(run_id, city, phase, fingerprint, status, _now())], PHASE_RUNS).coalesce(1).write.mode("append").parquet(path)


def read_phases(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, PHASE_RUNS)


def finished_as(spark: SparkSession, path: str, city: str, phase: str) -> str | None:
    """The fingerprint of the phase's latest run that was not skipped, if it succeeded."""
    last = read_phases(spark, path).where((F.col("city") == city) & (F.col("phase") == phase) & (F.col("status") != "skipped")).agg(
        F.max_by(F.struct("status", "fingerprint"), F.struct("event_at", "run_id")).alias("last")).first()["last"]
    return last["fingerprint"] if last and last["status"] == "success" else None


def part_events(spark: SparkSession, path: str, run_id: str, city: str, phase: str, parts: list[tuple[str, str, str]]) -> None:
    """Phase events of the tables a phase makes, as phase ``phase:table``: (table, fingerprint, status) each."""
    rows = [(run_id, city, f"{phase}:{name}", made_from, status, _now()) for name, made_from, status in parts]
    if rows:
        spark.createDataFrame(rows, PHASE_RUNS).coalesce(1).write.mode("append").parquet(path)


def finished_parts(spark: SparkSession, path: str, city: str, phase: str) -> dict[str, str]:
    """By table of the phase: the fingerprint of its latest build that was not skipped, if it succeeded."""
    own = read_phases(spark, path).where((F.col("city") == city) & F.col("phase").startswith(f"{phase}:") & (F.col("status") != "skipped"))
    last = own.groupBy("phase").agg(F.max_by(F.struct("status", "fingerprint"), F.struct("event_at", "run_id")).alias("last")).collect()
    return {r["phase"].split(":", 1)[1]: r["last"]["fingerprint"] for r in last if r["last"]["status"] == "success"}


def run_state(runs: DataFrame) -> DataFrame:
    """WIN-7: current state per run = its latest event; start time = its first."""
    last = runs.groupBy("run_id").agg(
        F.min("event_at").alias("started_at"),
        F.max_by(F.struct("city", "phases", "status", "error_message", "event_at"), F.col("event_at")).alias("s"),
    )
    return last.select(
        "run_id", "s.city", "started_at",
        F.when(F.col("s.status") != "running", F.col("s.event_at")).alias("finished_at"),
        "s.phases", "s.status", "s.error_message",
    )


def pending_files(manifest: DataFrame, log: DataFrame, city: str, layer: str, force: bool = False) -> DataFrame:
    """SRC-6: files without an earlier ``success`` for (city, layer); all of them when forced."""
    if force:
        return manifest
    done = log.where((F.col("city") == city) & (F.col("layer") == layer) & (F.col("status") == "success"))
    return manifest.join(done.select("file_name").distinct(), "file_name", "left_anti")


def ingestion_summary(log: DataFrame, city: str | None = None) -> DataFrame:
    """AGG-15: events per (city, layer, status), rows and latest time."""
    src = log.where(F.col("city") == city) if city else log
    return src.groupBy("city", "layer", "status").agg(
        F.count(F.lit(1)).cast("long").alias("events"),
        F.sum("row_count").cast("long").alias("rows"),
        F.max("ingested_at").alias("last_at"),
    )


def ingestion_history(log: DataFrame, city: str | None = None) -> DataFrame:
    """The per-event listing, newest first (SRT-2)."""
    src = log.where(F.col("city") == city) if city else log
    return src.select("city", "layer", "file_name", "ingested_at", "row_count", "file_size_mb", "status",
                      "duration_sec").orderBy(F.col("ingested_at").desc())
