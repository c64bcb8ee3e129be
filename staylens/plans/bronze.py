"""Bronze ingestion over landed files (JOB-1).

The source downloads each file, then verifies, counts and logs it, one file
at a time. Downloading is out of scope here (files are already landed in the
shared store); the rest is three steps: list the landed files (no content
read), count the records of the files still pending in ONE job (bad files are
set apart, see ``landing.count_each``), and append one batch of log events. A
failed file is an event, not an abort; the run is ``partial`` if this run's
events hold a failure, whatever earlier runs met.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from staylens.sources import landing, metadata


def ingest_bronze(spark: SparkSession, landing_dir: str, log_path: str, runs_path: str, city: str,
                  force: bool = False, glob: str = "*.csv*", source_url: str | None = None) -> dict:
    """Verify, count and log every pending landed file; returns {"status", "files", "summary"}.

    ``source_url`` is the folder the files were downloaded from, for the log.
    """
    run_id = metadata.new_run_id()
    metadata.run_event(spark, runs_path, run_id, city, ["bronze"], "running")
    try:
        files = landing.landed_files(spark, landing_dir, glob)
        pending = {r["file_name"] for r in metadata.pending_files(files, metadata.read_log(spark, log_path), city, "bronze", force)
                   .select("file_name").collect()}
        listed = landing.list_files(spark, landing_dir, glob)
        began = time.time()
        counts, errors = landing.count_each(spark, [path for name, path, size, _ in listed if name in pending and size > 0])
        took = round(time.time() - began, 3)
        events = []
        for name, path, size, _ in listed:
            url = f"{source_url.rstrip('/')}/{name}" if source_url else None
            if name not in pending:
                events.append(metadata.event(city, "bronze", name, "skipped", source_url=url))
                continue
            error = "empty file" if size == 0 else errors.get(path)
            # one job counts all files: its time is each file's
            events.append(metadata.event(
                city, "bronze", name, "failed" if error else "success", source_url=url, file_path=path, row_count=counts.get(path),
                file_size_mb=round(size / (1024 * 1024), 2), error_message=error, duration_sec=took))
        metadata.append_events(spark, log_path, events)
        status = "partial" if any(e[9] == "failed" for e in events) else "success"
        metadata.run_event(spark, runs_path, run_id, city, ["bronze"], status)
    except Exception as e:
        metadata.run_event(spark, runs_path, run_id, city, ["bronze"], "failed", str(e))
        raise
    return {"status": status, "files": len(events), "summary": metadata.ingestion_summary(metadata.read_log(spark, log_path), city)}
