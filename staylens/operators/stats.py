"""Statistics (ST-1 .. ST-4).

All sufficient statistics are declarative aggregates (regr_*, avg,
var_samp, count), so a table of any size reduces to one row per group with
partial aggregation. Only the p-value needs a function Spark SQL lacks (the
Student t CDF); it runs as a vectorized pandas UDF on the aggregated rows
(one row per test), never on table rows.
"""

from __future__ import annotations

from math import lgamma, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

ALPHA = 0.05


# ----------------------------------------------------------------- t distribution
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(40)
_PANELS = 24


def t_two_sided_p(t, df) -> np.ndarray:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom, elementwise.

    With t = sqrt(df) tan(a) the density becomes proportional to cos(a)^(df-1), so
    the tail is a smooth integral over a finite range. It is taken by Gauss-Legendre
    panels from the statistic's angle to where the integrand has fallen below
    1e-40 of its start, so that small p-values keep their relative accuracy.
    """
    t, df = np.broadcast_arrays(np.abs(np.asarray(t, dtype=float)), np.asarray(df, dtype=float))
    out = np.full(t.shape, np.nan)
    flat = out.reshape(-1)
    for i, (x, v) in enumerate(zip(t.reshape(-1), df.reshape(-1))):
        if not (np.isfinite(v) and v > 0) or np.isnan(x):
            continue
        if x == 0 or np.isinf(x):
            flat[i] = float(x == 0)
            continue
        start = np.arctan(x / np.sqrt(v))
        end = np.pi / 2
        if v > 1:  # cos(a)^(v-1) at the end is 1e-40 of that at the start
            end = np.arccos(np.cos(start) * 10.0 ** (-40.0 / (v - 1)))
        # panels grow geometrically: for v < 1 the integrand is steep at the right end
        edges = end - (end - start) * np.geomspace(1, 2.0**-_PANELS, _PANELS + 1) if v <= 1 else np.linspace(start, end, _PANELS + 1)
        if v <= 1:
            edges[-1] = end
        mid, half = (edges[1:] + edges[:-1]) / 2, (edges[1:] - edges[:-1]) / 2
        a = (mid[:, None] + half[:, None] * _NODES).ravel()
        log_scale = lgamma((v + 1) / 2) - lgamma(v / 2) - 0.5 * log(np.pi)
        value = np.exp((v - 1) * np.log(np.cos(a)) + log_scale)
        flat[i] = min(1.0, 2 * float((value * (half[:, None] * _WEIGHTS).ravel()).sum()))
    return out if out.shape else out[()]


@pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Vectorized two-sided p-value (applied to aggregated rows only)."""
    return pd.Series(t_two_sided_p(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan)))


# ----------------------------------------------------------------- OLS (ST-1, ST-3)
def ols(df: DataFrame, y: str, x: str, group: list[str] | None = None) -> DataFrame:
    """Simple linear regression of ``y`` on ``x`` (rows with a null in either dropped).

    Returns n, slope, intercept, r, r2 and the slope's standard error.
    """
    g = df.groupBy(*group) if group else df
    out = g.agg(
        F.regr_count(F.col(y), F.col(x)).cast("long").alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_sxx(F.col(y), F.col(x)).alias("__sxx"),
        F.regr_syy(F.col(y), F.col(x)).alias("__syy"),
        F.regr_sxy(F.col(y), F.col(x)).alias("__sxy"),
    )
    r = F.when(F.col("__sxx") * F.col("__syy") > 0, F.col("__sxy") / F.sqrt(F.col("__sxx") * F.col("__syy")))
    resid = F.greatest(F.col("__syy") - F.col("slope") * F.col("__sxy"), F.lit(0.0))
    stderr = F.sqrt(F.try_divide(F.try_divide(resid, (F.col("n") - 2).cast("double")), F.col("__sxx")))
    return out.withColumns({"r": r, "stderr": stderr}).drop("__sxx", "__syy", "__sxy")


def with_significance(tests: DataFrame, stat: str, df_col: str, alpha: float = ALPHA) -> DataFrame:
    """ST-2: p-value and the verdict ``p < alpha``."""
    p = t_pvalue(F.col(stat), F.col(df_col))
    return tests.withColumn("p_value", p).withColumn("significant", F.col("p_value") < alpha)


def ols_pvalue(fit: DataFrame) -> DataFrame:
    """Slope t statistic on n-2 degrees of freedom, then ST-2."""
    t = F.try_divide(F.col("slope"), F.col("stderr"))
    return with_significance(fit.withColumns({"t_stat": t, "dof": (F.col("n") - 2).cast("double")}), "t_stat", "dof")


def fitted(df: DataFrame, fit: DataFrame, x: str, out: str = "fitted") -> DataFrame:
    """ST-3 trend line values: intercept + slope * x, slope/intercept as scalar subqueries."""
    slope = fit.select("slope").scalar()
    intercept = fit.select("intercept").scalar()
    return df.withColumn(out, intercept + slope * F.col(x))


# ----------------------------------------------------------------- from centred moments
def ols_from_moments(m: DataFrame) -> DataFrame:
    """OLS from centred moments (``joinagg.pair_moments``), one row per target. Same outputs as ``ols``."""
    ok = (F.col("n") > 0) & (F.col("sxx") > 0)
    both = F.col("sxx") * F.col("syy")
    out = m.withColumn("slope", F.when(ok, F.col("sxy") / F.col("sxx")))
    out = out.withColumns({
        "intercept": F.when(ok, F.col("mean_y") - F.col("slope") * F.col("mean_x")),
        "r2": F.when(ok, F.when(F.col("syy") <= 0, F.lit(1.0)).otherwise(F.col("sxy") * F.col("sxy") / both)),
        "r": F.when(both > 0, F.col("sxy") / F.sqrt(both)),
    })
    resid = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    out = out.withColumn("stderr", F.sqrt(F.try_divide(F.try_divide(resid, (F.col("n") - 2).cast("double")), F.col("sxx"))))
    return out.drop("mean_x", "mean_y", "sxx", "syy", "sxy")


def group_moments(df: DataFrame, value: str, group: str) -> DataFrame:
    """Centred moments per group of one table (Spark's variance is merged pairwise); a null group is left out."""
    return (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).cast("long").alias("n"), F.avg(value).alias("mean_y"), (F.var_pop(value) * F.count(F.lit(1))).alias("syy"))
    )


def welch_from_moments(m: DataFrame, group: str, first: object = True) -> DataFrame:
    """ST-4: two-sample t test with unequal variances from per-group (n, mean_y, syy), ``first`` vs the rest.

    The two group rows are folded into one by conditional aggregates (no join).
    """
    var = F.try_divide(F.col("syy"), (F.col("n") - 1).cast("double"))
    s = m.select(group, F.col("n"), F.col("mean_y").alias("mean"), var.alias("var"))
    is1 = F.col(group) == F.lit(first)
    one = s.agg(
        F.max(F.when(is1, F.col("n"))).alias("n1"), F.max(F.when(~is1, F.col("n"))).alias("n2"),
        F.max(F.when(is1, F.col("mean"))).alias("mean1"), F.max(F.when(~is1, F.col("mean"))).alias("mean2"),
        F.max(F.when(is1, F.col("var"))).alias("var1"), F.max(F.when(~is1, F.col("var"))).alias("var2"),
    )
    se1 = F.col("var1") / F.col("n1")
    se2 = F.col("var2") / F.col("n2")
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(se1 + se2))
    dof = F.try_divide((se1 + se2) * (se1 + se2), se1 * se1 / (F.col("n1") - 1) + se2 * se2 / (F.col("n2") - 1))
    return one.withColumns({"t_stat": t, "dof": dof})
