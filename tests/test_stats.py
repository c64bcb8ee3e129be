"""Statistics: t distribution against table values; OLS against MLlib; Welch by formula."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.operators import stats


@pytest.mark.parametrize("t,df,p", [
    (2.228139, 10, 0.05), (12.7062, 1, 0.05), (4.032143, 5, 0.01), (1.959964, 1e7, 0.05), (0.0, 7, 1.0),
    (-2.228139, 10, 0.05),
])
def test_t_two_sided_table_values(t, df, p):
    assert stats.t_two_sided_p(t, df) == pytest.approx(p, abs=2e-6)


def test_t_tails():
    """Closed forms for 1, 2 and 4 degrees of freedom, and the order of far tails."""
    for t in (0.01, 0.5, 2.0, 30.0):
        assert stats.t_two_sided_p(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert stats.t_two_sided_p(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
        u = t * t / (4 + t * t)
        assert stats.t_two_sided_p(t, 4) == pytest.approx(1 - 1.5 * math.sqrt(u) * (1 - u / 3), rel=1e-6)
    assert 0 < stats.t_two_sided_p(40.0, 20) < 1e-15
    assert np.isnan(stats.t_two_sided_p(float("nan"), 5)) and np.isnan(stats.t_two_sided_p(1.0, 0))


def test_ols_matches_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rnd = random.Random(5)
    rows = [(float(x), 3.0 + 0.2 * x + rnd.gauss(0, 4)) for x in [rnd.uniform(0, 20) for _ in range(300)]]
    df = spark.createDataFrame(rows, "x double, y double")
    fit = stats.ols_pvalue(stats.ols(df, "y", "x")).first()
    lr = LinearRegression(featuresCol="f", labelCol="y", solver="normal").fit(
        VectorAssembler(inputCols=["x"], outputCol="f").transform(df))
    assert fit.slope == pytest.approx(lr.coefficients[0], rel=1e-9)
    assert fit.intercept == pytest.approx(lr.intercept, rel=1e-9)
    assert fit.stderr == pytest.approx(lr.summary.coefficientStandardErrors[0], rel=1e-6)
    assert fit.p_value == pytest.approx(lr.summary.pValues[0], abs=1e-9)
    assert fit.r2 == pytest.approx(lr.summary.r2, rel=1e-9)
    assert fit.r ** 2 == pytest.approx(fit.r2, rel=1e-9)


def test_welch_by_formula(spark):
    a = [1.0, 2.0, 3.0, 4.0, 10.0]
    b = [2.0, 2.5, 2.0, 3.0]
    df = spark.createDataFrame([(v, True) for v in a] + [(v, False) for v in b] + [(99.0, None)], "price double, s boolean")
    w = stats.with_significance(stats.welch_from_moments(stats.group_moments(df, "price", "s"), "s", True), "t_stat", "dof").first()
    m1, m2, v1, v2 = np.mean(a), np.mean(b), np.var(a, ddof=1), np.var(b, ddof=1)
    t = (m1 - m2) / math.sqrt(v1 / 5 + v2 / 4)
    dof = (v1 / 5 + v2 / 4) ** 2 / ((v1 / 5) ** 2 / 4 + (v2 / 4) ** 2 / 3)
    assert (w.n1, w.n2) == (5, 4)
    assert w.t_stat == pytest.approx(t, rel=1e-12) and w.dof == pytest.approx(dof, rel=1e-12)
    assert w.p_value == pytest.approx(stats.t_two_sided_p(t, dof), rel=1e-12)
    assert w.significant == (w.p_value < 0.05)


def test_fitted_line(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (2.0, 5.0)], "x double, y double")
    out = stats.fitted(df, stats.ols(df, "y", "x"), "x").select("fitted").collect()
    assert [r[0] for r in out] == pytest.approx([1.0, 3.0, 5.0])
