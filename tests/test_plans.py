"""Physical-plan guards for every registered query (scale rules, checked on sf0.001).

* no cartesian product / nested-loop join anywhere;
* Python (Arrow) UDFs only in the p-value queries, where they see aggregated rows;
* no row-at-a-time Python UDF at all;
* scans read only needed columns of the wide driver tables.
"""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"
PANDAS_UDF_OK = {"ols_significance", "welch_pvalue"}
#: Queries of the optional subpackage have tests of their own.
KEYS = sorted(k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def few_trees():
    """The model queries' plans don't depend on the number of trees: fit a small model for them."""
    from staylens.plans import queries

    full = queries.trained_model
    queries.trained_model = lambda spark, sf, max_iter=3: full(spark, sf, max_iter)
    yield
    queries.trained_model = full


@pytest.mark.parametrize("key", KEYS)
def test_plan_rules(spark, key):
    df = E.queries()[key](spark, SF)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # row-at-a-time Python UDF
    if key not in PANDAS_UDF_OK:
        assert "ArrowEvalPython" not in plan
    # the wide fact table is never read whole
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString()):
        cols = schema.split(",")
        if any(c.startswith("l_") for c in cols):
            assert len(cols) <= 6, schema


PRE_AGGREGATED = ["area_prices", "area_room_prices", "superhost_share", "tenure_cohorts", "ols_tenure", "welch_ttest",
                  "kpis", "room_type_mix", "dq_listing_report", "profile", "price_histogram"]


def _raw_shuffles(plan: str) -> list[str]:
    """Hash exchanges whose input is not an aggregate (i.e. raw rows are shuffled)."""
    lines = plan.split("\n")
    out = []
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln:
            child = next(c for c in lines[i + 1:] if "Sort [" not in c)
            if "Aggregate" not in child:
                out.append(child.strip())
    return out


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", PRE_AGGREGATED)
def test_only_aggregated_rows_are_shuffled(no_broadcast, key):
    """With joins planned as sort-merge joins (as at scale), every shuffle of these
    queries moves per-key partial aggregates, never raw rows (hot keys are reduced
    map-side before any exchange)."""
    plan = plan_text(E.queries()[key](no_broadcast, SF))
    assert _raw_shuffles(plan) == []


@pytest.mark.parametrize("key", ["occupancy", "occupancy_recomputed"])
def test_occupancy_shuffles_calendar_only_aggregated(no_broadcast, key):
    """The geography is bucketed by listing, the calendar is summed up per listing before it moves."""
    assert _raw_shuffles(plan_text(E.queries()[key](no_broadcast, SF))) == []


def _exchanges_below_join(plan: str) -> int:
    """Exchanges under the last join (the mart join; what stands above it only moves groups)."""
    lines = plan.split("\n")
    at = max(i for i, ln in enumerate(lines) if "Join " in ln)
    return sum("Exchange " in ln for ln in lines[at + 1:])


@pytest.mark.parametrize("key,exchanges", [("area_prices", 0), ("area_room_prices", 0), ("occupancy", 0), ("price_histogram", 0),
                                           ("superhost_share", 1), ("tenure_cohorts", 1)])
def test_mart_joins_are_co_partitioned(no_broadcast, key, exchanges):
    """Marts by listing share their buckets, so their joins exchange nothing. Of the joins by host only the listings'
    partial sums move: a host may have a third of all listings, so listings are not bucketed by host."""
    assert _exchanges_below_join(plan_text(E.queries()[key](no_broadcast, SF))) == exchanges


def test_marts_are_built_when_asked_for(spark, tmp_dir):
    from staylens.plans import queries as Q

    base = os.path.join(tmp_dir, "gold")
    built = Q.build_gold(spark, SF, ("listings_full",), base, {})
    assert list(built) == ["listings_full"] and os.listdir(base) == ["silver"]
    Q.build_gold(spark, SF, ("dim_geography",), base, built)
    assert set(built) == {"listings_full", "dim_geography", "dim_geography_table"}
    assert set(Q.build_gold(spark, SF, (), base, built)) >= {"calendar", "reviews", *Q.MART_INPUTS}


def test_requests_are_spread(spark):
    from staylens.plans import domain

    plan = domain.requests(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan
