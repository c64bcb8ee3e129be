"""Join aggregates from per-key partials equal the aggregates over the materialized join."""

import random

import pytest
from pyspark.sql import functions as F

from staylens.operators import joinagg, stats


@pytest.fixture(scope="module")
def frames(spark):
    rnd = random.Random(9)
    # key 0 is hot: a third of the fact rows and several dim rows (copies)
    fact = [(0 if i % 3 == 0 else rnd.randint(1, 40), rnd.choice(["x", "y"]), rnd.choice([None, 1.0, 2.5, 7.25, 100.0]))
            for i in range(900)]
    dim = [(k, rnd.choice(["A", "B", None]), float(rnd.randint(0, 9))) for k in range(0, 45) for _ in range(1 + (k % 3))]
    dim += [(0, "A", 3.0)] * 4
    f = spark.createDataFrame(fact, "k long, room string, price double")
    d = spark.createDataFrame(dim, "k long, area string, x double")
    return f, d


def test_count_and_means(frames):
    f, d = frames
    got = joinagg.count_and_means(f, d, "k", ["room"], ["area"], {"avg_price": F.col("price")}, "n")
    want = f.join(d, "k").groupBy("area", "room").agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("avg_price"))
    g = {(r.area, r.room): (r.n, r.avg_price) for r in got.collect()}
    w = {(r.area, r.room): (r.n, r.avg_price) for r in want.collect()}
    assert g.keys() == w.keys()
    for k in w:
        assert g[k][0] == w[k][0] and g[k][1] == pytest.approx(w[k][1], rel=1e-12)


def test_pair_counts(frames):
    f, d = frames
    got = {r.area: r["count"] for r in joinagg.pair_counts(f, d, "k", ["area"]).collect()}
    want = {r.area: r["count"] for r in f.join(d, "k").groupBy("area").count().collect()}
    assert got == want


def test_moments_ols_and_welch(frames):
    f, d = frames
    m = joinagg.pair_moments(f, d, "k", {"price": F.col("price")}, F.col("x"))
    got = stats.ols_from_moments(m).first()
    want = stats.ols(f.join(d, "k"), "price", "x").first()
    for c in ["n", "slope", "intercept", "r2", "r", "stderr"]:
        assert getattr(got, c) == pytest.approx(getattr(want, c), rel=1e-9)
    d2 = d.where(F.col("area").isNotNull())
    mw = joinagg.pair_moments(f, d2, "k", {"price": F.col("price")}, F.lit(1.0), ["area"])
    gw = stats.welch_from_moments(mw, "area", "A").first()
    ww = stats.welch_from_moments(stats.group_moments(f.join(d2, "k"), "price", "area"), "area", "A").first()
    for c in ["n1", "n2", "mean1", "mean2", "var1", "var2", "t_stat", "dof"]:
        assert getattr(gw, c) == pytest.approx(getattr(ww, c), rel=1e-9)


def test_no_pairs_materialized(frames):
    f, d = frames
    j = joinagg.weighted_pairs(f, d, "k", ["room"], ["area"], {"p": F.col("price")})
    # at most one row per (key, room, area): the hot key is not expanded
    assert j.where(F.col("k") == 0).count() <= 2 * 3


def test_moments_do_not_cancel(spark):
    """Values near 1e9 (and groups far apart) with a spread of 6: variances stay exact."""
    rows = [(i % 50, 1e9 + i % 7) for i in range(700)] + [(50 + i % 50, float(i % 7)) for i in range(700)]
    f = spark.createDataFrame(rows, "k long, price double")
    d = spark.createDataFrame([(k, k < 50, 1e9 + k % 5) for k in range(100)], "k long, s boolean, x double")
    w = stats.welch_from_moments(joinagg.pair_moments(f, d, "k", {"price": F.col("price")}, F.lit(1.0), ["s"]), "s", True).first()
    assert w.var1 == pytest.approx(4.0 * 700 / 699, rel=1e-6) and w.var2 == pytest.approx(4.0 * 700 / 699, rel=1e-6)
    assert w.mean1 == pytest.approx(1e9 + 3, abs=1e-6)
    m = stats.ols_from_moments(joinagg.pair_moments(f, d, "k", {"a": F.col("price"), "b": F.col("price") * 2}, F.col("x"))).collect()
    assert {r.target for r in m} == {"a", "b"} and all(r.n == 1400 for r in m)
    near = f.where("k < 50")
    fit = stats.ols_from_moments(joinagg.pair_moments(near, d, "k", {"a": F.col("price")}, F.col("x"))).first()
    pairs = [(1e9 + k % 5, p) for k, p in rows[:700]]
    mx, my = sum(x - 1e9 for x, _ in pairs) / 700, sum(y - 1e9 for _, y in pairs) / 700
    sxy = sum((x - 1e9 - mx) * (y - 1e9 - my) for x, y in pairs)
    sxx = sum((x - 1e9 - mx) ** 2 for x, _ in pairs)
    assert fit.slope == pytest.approx(sxy / sxx, rel=1e-6, abs=1e-9)
