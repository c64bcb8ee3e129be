"""Benchmark the headline queries.

Runs every query once to warm up, then three timed runs each, and prints ONE JSON
line: {"metric", "value" (sum of per-query medians), "unit", "queries", "sf"}.
Queries execute fully through the ``noop`` sink (no collect to the driver).
``gold_build`` times the silver + gold build (written Parquet marts) that the
analytic queries read, so the sum covers building the marts too.

``work`` times what the headline queries read as finished tables (dedup, host
DISTINCT, rule reports, landed CSV to silver) and the model: the fit of all 500
trees, attribution and the borough comparison (one run each, after the fit).

Work that would begin after BENCH_LIMIT seconds (default 900) is left out and said on stderr.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma list to restrict).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_build",  # the pipeline step the analytic queries read from (timed fresh every run)
    "area_prices",
    "kpis",
    "room_type_mix",
    "superhost_share",
    "occupancy",
    "area_room_prices",
    "comparables",
    "tenure_cohorts",
    "price_histogram",
    "profile",
    "dq_listing_report",
    "dq_calendar_report",
    "dim_hosts",
    "fact_calendar",
    "dedup_reviews",
    "parse_amenities",
    "ols_tenure",
    "welch_ttest",
    "revenue_grid",
    "feature_table",
]


def work(spark, sf: str) -> dict:
    """Callables that do the work behind finished tables, from the driver tables or the landed files."""
    from staylens.operators import quality
    from staylens.plans import domain, gold, queries, silver

    def flagged():
        return quality.apply_flags(domain.listings(spark, sf), quality.listing_rules(domain.CITY_BOUNDS, domain.AS_OF))

    return {
        "dedup_reviews_work": lambda: silver.clean_reviews(domain.raw_reviews(spark, sf)),
        "dim_hosts_work": lambda: gold.dim_hosts(quality.valid_subset(flagged())),
        "dq_listing_work": lambda: quality.rule_report(flagged(), quality.listing_rules(domain.CITY_BOUNDS, domain.AS_OF)),
        "csv_to_silver_listings": lambda: queries.REGISTRY["silver_listings_csv"](spark, sf),
        "csv_to_silver_calendar": lambda: queries.REGISTRY["silver_calendar_csv"](spark, sf),
        "csv_to_silver_reviews": lambda: queries.REGISTRY["silver_reviews_csv"](spark, sf),
    }


MODEL_WORK = ["price_model_metrics", "attribution", "borough_comparison"]  # the first one fits the model


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from staylens.plans.queries import REGISTRY, build_gold
    from staylens.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2), app="staylens-bench")
    names = only or HEADLINE
    began, limit = time.perf_counter(), float(os.environ.get("BENCH_LIMIT", "900"))
    times: dict[str, float] = {}

    def once(name: str) -> float:
        t0 = time.perf_counter()
        if name == "gold_build":
            build_gold(spark, sf_dir)  # silver + marts written from the driver tables, fresh folder
        else:
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up pass over every query (JIT, codegen cache, file listing)
        once(name)
    for name in names:
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    extra: dict[str, float] = {}
    if not only:
        def run(df) -> float:
            t0 = time.perf_counter()
            df().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        # the first run of each is timed as well, so that one slow job can't take the headline's figures with it
        jobs = {**work(spark, sf_dir), **{("model_fit_500" if n == MODEL_WORK[0] else n): (lambda n=n: REGISTRY[n](spark, sf_dir)) for n in MODEL_WORK}}
        for name, df in jobs.items():
            if time.perf_counter() - began > limit:
                print(f"# {name}: left out, the bench has run for {limit} s", file=sys.stderr, flush=True)
                continue
            extra[name] = round(run(df), 3)
            if name not in MODEL_WORK and name != "model_fit_500" and time.perf_counter() - began < limit / 2:
                extra[name] = round(statistics.median(run(df) for _ in range(runs)), 3)
            print(f"# {name}: {extra[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "work": extra,
        "work_value": round(sum(extra.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
