"""Driver contract: entry smoke, registry/oracle consistency, oracle match at sf0.001."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402

#: Fitted models: their arithmetic has oracle rows of its own (``mean_predictor_*``, ``top_impacts``).
ROWS_ONLY = {"attribution", "baseline_model", "borough_comparison", "comparable_check", "price_estimate", "price_model_metrics"}


def is_llm(key: str) -> bool:
    """Queries of the optional subpackage, which has tests of its own."""
    return bool(re.match(r"op\d+_|pipeline$", key))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["neighbourhood", "avg_price", "listing_count"]


def test_every_query_has_oracle_or_is_documented():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert {k for k in set(q) - set(s) if not is_llm(k)} == ROWS_ONLY


@pytest.fixture(scope="module")
def con():
    return duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_oracle_match_sf0001(spark, con, key):
    ok, msg, _, _ = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], "/root/testdata/sf0.001")
    assert ok, msg
