"""Whole pipeline by phase list (JOB-8).

Phases run in order; a failed phase is recorded and later phases still run.
Unlike the source, a phase with failed datasets reports ``partial`` instead
of ``success``, and the gold phase really builds the marts (JOB-7).
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from staylens.functions.values import LANDED_FILES
from staylens.plans import bronze, gold, silver
from staylens.session import narrow_codegen
from staylens.sources import csv, landing, metadata, snapshots
from staylens.sources.snapshots import Folders
from staylens.sources.tables import version


ALL_PHASES = ["bronze", "silver", "gold"]


@dataclass
class Layout:
    landing_dir: str
    silver_dir: str
    gold_dir: str
    log_path: str
    runs_path: str
    store: type = Folders  # Snapshots: silver and gold tables change by one atomic commit each

    @property
    def phases_path(self) -> str:
        return f"{self.runs_path.rstrip('/')}-phases"


def _sources(spark: SparkSession, landing_dir: str) -> dict[str, str | None]:
    """SRC-4 per dataset: a flat landing folder resolved by preferred file names,
    then any file with the dataset's name fragment and suffix; else a per-dataset
    subfolder of part files (the layout Spark writes). Missing -> None."""
    out = {}
    for name, (preferred, fragment, suffix) in LANDED_FILES.items():
        path = csv.resolve_dataset(spark, landing_dir, preferred, fragment, suffix)
        if path is None:
            path = csv.resolve_dataset(spark, f"{landing_dir}/{name}", [], "", suffix)
            path = path.rsplit("/", 1)[0] if path else None
        out[name] = path
    return out


def _raw_inputs(spark: SparkSession, sources: dict[str, str | None], partitions: int | None) -> dict:
    return {name: csv.read_landed_csv(spark, path, None, partitions, multiline=name != "neighbourhoods") if path else None
            for name, path in sources.items()}


#: Raise it when a phase makes other tables of the same input.
CODE_VERSION = 1


def fingerprint(spark: SparkSession, phase: str, city: silver.CityConfig, layout: Layout, as_of: str | None) -> str:
    """A hash of all that a phase's result depends on: its input's versions, its settings and the code's version."""
    if phase == "gold":
        inputs = [_table_version(spark, layout, name) for name in ("listings", "calendar", "reviews")]
    else:
        inputs = [(name, size, str(modified)) for name, _, size, modified in landing.list_files(spark, layout.landing_dir)]
    settings = asdict(city) if phase != "bronze" else {"name": city.name}
    return hashlib.sha256(json.dumps([phase, CODE_VERSION, inputs, settings, as_of if phase == "silver" else None], default=str).encode()).hexdigest()


def _hash(*made_from) -> str:
    return hashlib.sha256(json.dumps([CODE_VERSION, *made_from], default=str).encode()).hexdigest()


def dataset_fingerprints(spark: SparkSession, sources: dict[str, str | None], city: silver.CityConfig, as_of: str | None) -> dict[str, str]:
    """By landed dataset: a hash of its files and of the silver step's settings."""
    listed = {n: [(p, size, str(at)) for _, p, size, at in landing.list_files(spark, path)] for n, path in sources.items() if path}
    return {n: _hash("silver", n, files, asdict(city), as_of) for n, files in listed.items()}


def mart_fingerprints(spark: SparkSession, layout: Layout) -> dict[str, str]:
    """By mart: a hash of the version of the silver table it is made from."""
    return {mart: _hash("gold", mart, _table_version(spark, layout, table)) for mart, table in gold.MADE_FROM.items()}


def _table_version(spark: SparkSession, layout: Layout, table: str):
    path = f"{layout.silver_dir}/{table}.parquet"
    found = snapshots.current(spark, path) if layout.store is snapshots.Snapshots else None
    return sorted(found.parts.values()) if found else version(spark, path)


def _unchanged(spark: SparkSession, layout: Layout, run_id: str, city: str, phase: str, made_from: dict[str, str], resume: bool) -> set[str]:
    """The tables of a phase whose last build succeeded on the same fingerprint; the others are marked as begun, so
    that a build that never ended counts as none."""
    before = metadata.finished_parts(spark, layout.phases_path, city, phase) if resume else {}
    same = {n for n, f in made_from.items() if before.get(n) == f}
    metadata.part_events(spark, layout.phases_path, run_id, city, phase, [(n, f, "running") for n, f in made_from.items() if n not in same])
    return same


def run(spark: SparkSession, city: silver.CityConfig, phases: list[str], layout: Layout, force: bool = False,
        as_of: str | None = None, partitions: int | None = None, resume: bool = False) -> dict[str, dict]:
    """Run phases in order. With ``resume`` a phase whose last run succeeded on the same fingerprint is skipped:
    a rerun after a failure, or after new files, does only what is left or has changed; in a phase that runs, so are
    the datasets and marts that are made from the same files or table as before. (With ``as_of`` unset the
    silver phase depends on the day, which the fingerprint does not hold: give a date.)"""
    narrow_codegen(spark)
    phases = [p for phase in phases for p in (ALL_PHASES if phase == "all" else [phase])]
    run_id = metadata.new_run_id()
    metadata.run_event(spark, layout.runs_path, run_id, city.name, phases, "running")
    results: dict[str, dict] = {}
    for phase in phases:
        t0, made_from = time.time(), None
        try:
            if phase in ALL_PHASES:
                made_from = fingerprint(spark, phase, city, layout, as_of)
                if resume and not force and metadata.finished_as(spark, layout.phases_path, city.name, phase) == made_from:
                    results[phase] = {"status": "skipped", "duration_sec": round(time.time() - t0, 1), "detail": {}}
                    metadata.phase_event(spark, layout.phases_path, run_id, city.name, phase, made_from, "skipped")
                    continue
            if phase == "bronze":
                detail = bronze.ingest_bronze(spark, layout.landing_dir, layout.log_path, layout.runs_path, city.name, force)
                status = detail["status"]
            elif phase == "silver":
                sources = _sources(spark, layout.landing_dir)
                parts = dataset_fingerprints(spark, sources, city, as_of)
                same = _unchanged(spark, layout, run_id, city.name, phase, parts, resume and not force)
                raw = _raw_inputs(spark, {n: p for n, p in sources.items() if n not in same}, partitions)
                detail = silver.run_silver(spark, raw, layout.silver_dir, city, as_of, log=layout.log_path, store=layout.store, same=same)
                status = "success" if all(v.get("status") in ("success", "skipped") for v in detail.values()) else "partial"
                metadata.part_events(spark, layout.phases_path, run_id, city.name, phase, [(n, f, detail[n]["status"]) for n, f in parts.items()])
            elif phase == "gold":
                silver_tables = [layout.store.load(spark, f"{layout.silver_dir}/{n}.parquet") for n in ("listings", "calendar", "reviews")]
                parts = mart_fingerprints(spark, layout)
                same = _unchanged(spark, layout, run_id, city.name, phase, parts, resume and not force)
                marts = gold.build_marts(*silver_tables)
                detail = gold.write_marts({n: df for n, df in marts.items() if n not in same}, layout.gold_dir, layout.store)
                status = "success"
                metadata.part_events(spark, layout.phases_path, run_id, city.name, phase, [(n, f, "skipped" if n in same else status) for n, f in parts.items()])
            else:
                raise ValueError(f"unknown phase {phase}")
            results[phase] = {"status": status, "duration_sec": round(time.time() - t0, 1), "detail": detail}
        except Exception as e:  # recorded; the next phase still runs
            results[phase] = {"status": "failed", "error": str(e)}
        metadata.phase_event(spark, layout.phases_path, run_id, city.name, phase, made_from or "", results[phase]["status"])
    states = {"success" if r["status"] == "skipped" else r["status"] for r in results.values()}
    final = "success" if states <= {"success"} else "failed" if states == {"failed"} else "partial"
    metadata.run_event(spark, layout.runs_path, run_id, city.name, phases, final)
    return results
