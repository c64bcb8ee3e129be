"""Property-based checks of the parsers (hypothesis), evaluated in one Spark job per property."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylens.functions import parse, text

SETTINGS = settings(max_examples=25, deadline=None)


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=1, max_size=40))
def test_money_text_round_trips(spark, cents):
    texts = [f"${c // 100:,}.{c % 100:02d}" for c in cents]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(parse.parse_price("v")).collect()]
    assert got == [float(f"{c // 100}.{c % 100:02d}") for c in cents]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789.,$-+eE dNaIinf", max_size=12), min_size=1, max_size=40))
def test_money_parse_is_finite_or_null(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for r in df.select(parse.parse_price("v").alias("p"), parse.safe_double("v").alias("d")).collect():
        for v in (r.p, r.d):
            assert v is None or math.isfinite(v)


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZ /-'&1 2", max_size=16), min_size=1, max_size=40))
def test_title_case_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(text.title_case(F.col("v"))).collect()]
    assert got == [t.title() for t in texts]
