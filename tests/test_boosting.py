"""Second-order boosting, its barrier stages, and attributions against all coalitions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.operators import boosting as B

NAMES = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = np.stack([r.integers(0, 2, 3000), r.integers(0, 5, 3000), r.normal(size=3000).round(1), r.integers(0, 2, 3000), r.integers(0, 9, 3000), r.integers(0, 3, 3000)], axis=1).astype(float)
    y = 30 * x[:, 0] * (x[:, 1] > 2) + 5 * x[:, 2] + x[:, 4] ** 2 + r.normal(size=3000)
    df = spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))], ["id", *NAMES, "y"]).repartition(3)
    return df, x, y


def test_one_tree_is_the_best_by_brute_force(spark, rows):
    df, x, y = rows
    p = B.BoostParams(max_iter=1, max_depth=1, step_size=1.0, subsampling_rate=1.0, columns=1.0, min_child_weight=5, l2=2.0)
    m = B.fit(df, NAMES, "y", "id", p)
    g = y.mean() - y
    best = max(((s, k, c) for k in range(6) for c in np.unique(x[:, k])[:-1]
                for left in [x[:, k] <= c] if left.sum() >= 5 and (~left).sum() >= 5
                for s in [g[left].sum() ** 2 / (left.sum() + 2) + g[~left].sum() ** 2 / ((~left).sum() + 2)]))
    assert (m.feature[0, 0], m.threshold[0, 0]) == (best[1], best[2])
    left = x[:, best[1]] <= best[2]
    assert m.value[0] == pytest.approx([-g[left].sum() / (left.sum() + 2), -g[~left].sum() / ((~left).sum() + 2)])


def test_barrier_stages_give_the_same_trees(spark, rows):
    df, x, y = rows
    one = B.fit(df, NAMES, "y", "id", B.BoostParams(max_iter=3, max_depth=3))
    many = B.fit(df, NAMES, "y", "id", B.BoostParams(max_iter=3, max_depth=3, trees_per_stage=2, rows_per_task=800))
    assert (one.feature == many.feature).all() and (one.threshold == many.threshold).all()
    assert many.value == pytest.approx(one.value) and many.base == pytest.approx(one.base)


def test_quality_and_scoring(spark, rows):
    df, x, y = rows
    m = B.fit(df.where("id % 5 > 0"), NAMES, "y", "id", B.BoostParams(max_iter=120, step_size=0.2))
    scored = B.transform(m, df.withColumn("c", F.when(F.col("id") != 7, F.col("c"))), NAMES)
    got = {r["id"]: r["prediction"] for r in scored.collect()}
    assert scored.columns == [*df.columns, "prediction"] and got.pop(7) is None
    assert [got[i] for i in sorted(got)] == pytest.approx(m.predict(np.delete(x, 7, axis=0)).tolist())
    held = np.arange(3000) % 5 == 0
    error = y[held] - m.predict(x[held])
    assert 1 - (error**2).sum() / ((y[held] - y[held].mean()) ** 2).sum() > 0.95
    assert B.BoostedTrees.of_rows(m.rows()).predict(x[:50]) == pytest.approx(m.predict(x[:50]))


def test_attribution_is_shapley_over_all_coalitions(spark, rows):
    df, x, _ = rows
    m = B.fit(df, NAMES, "y", "id", B.BoostParams(max_iter=25, max_depth=4, step_size=0.3))
    background = x[100:104]
    worker = B.Attributor(B.leaf_paths(m), background, 6)
    for row in x[:8]:
        want = np.zeros((4, 6))
        for j, z in enumerate(background):
            value = {}
            for n in range(7):
                for s in itertools.combinations(range(6), n):
                    mixed = z.copy()
                    mixed[list(s)] = row[list(s)]
                    value[s] = m.predict(mixed[None])[0]
            for i in range(6):
                for s, v in value.items():
                    if i not in s:
                        w = math.factorial(len(s)) * math.factorial(5 - len(s)) / math.factorial(6)
                        want[j, i] += w * (value[tuple(sorted((*s, i)))] - v)
        assert worker.impacts(row) == pytest.approx(want, abs=1e-9)
    out = B.attribute(m, df.where("id < 5"), "id", NAMES, background.tolist()).collect()
    for i in range(5):
        assert sum(r["impact"] for r in out if r["id"] == i) == pytest.approx(m.predict(x[i : i + 1])[0] - m.predict(background).mean(), abs=1e-9)


def test_empty_and_constant(spark):
    empty = spark.createDataFrame([], "id long, a double, y double")
    m = B.fit(empty, ["a"], "y", "id", B.BoostParams(max_iter=2))
    assert m.predict(np.zeros((2, 1))).tolist() == [0.0, 0.0]
    same = spark.range(50).selectExpr("id", "1.0D AS a", "5.0D AS y")
    m = B.fit(same, ["a"], "y", "id", B.BoostParams(max_iter=2))
    assert m.predict(np.ones((1, 1))).tolist() == [5.0] and np.isinf(m.threshold).all()


def test_a_round_exchanges_once_a_level(rows):
    _, x, y = rows
    p, calls = B.BoostParams(max_depth=3).of_rows(250_001), []
    cuts = [np.unique(x[:, i])[:-1].tolist() for i in range(6)]
    grower = B._Grower(cuts, p, lambda a: calls.append(a.shape) or a)
    code, joint = grower.codes(x)
    grower.load(code, joint, y, np.arange(len(y), dtype=np.uint64))
    margin = np.full(len(y), y.mean())
    trees = grower.grow(list(range(p.at_once)), margin.copy(), margin)
    assert p.at_once == len(trees) == 10 and len(calls) == 3
    assert B.BoostParams(subsampling_rate=1.0, columns=1.0).of_rows(10**7).at_once == B.BoostParams().of_rows(250_000).at_once == 1
    m = B.BoostedTrees(y.mean(), *[np.array([t[i] for t in trees]) for i in range(3)])
    assert m.predict(x) == pytest.approx(margin)


def test_rounds_over_tasks_and_stages_give_the_same_trees(spark, rows):
    df, x, y = rows
    settings = {"max_iter": 12, "max_depth": 3, "round_rows": 1000}
    one = B.fit(df, NAMES, "y", "id", B.BoostParams(**settings))
    many = B.fit(df, NAMES, "y", "id", B.BoostParams(**settings, trees_per_stage=7, rows_per_task=1600))
    assert (one.feature == many.feature).all() and (one.threshold == many.threshold).all()
    assert many.value == pytest.approx(one.value)


def test_trees_do_not_depend_on_a_number_of_rows(spark, rows):
    """The trees of a fit are those that grow one after another, above ``round_rows`` rows too, in one task or in several."""
    df, x, y = rows
    settings = {"max_iter": 12, "max_depth": 3}
    few = B.fit(df, NAMES, "y", "id", B.BoostParams(**settings))
    for more in ({"round_rows": 1000}, {"round_rows": 1000, "rows_per_task": 1600, "trees_per_stage": 7}):
        many = B.fit(df, NAMES, "y", "id", B.BoostParams(**settings, **more))
        assert (few.feature == many.feature).all() and (few.threshold == many.threshold).all()
        assert many.value == pytest.approx(few.value)


def test_rounds_that_a_caller_asks_for_over_tasks_and_stages(spark, rows):
    df, x, y = rows
    settings = {"max_iter": 12, "max_depth": 3, "at_once": 10}
    one = B.fit(df, NAMES, "y", "id", B.BoostParams(**settings))
    many = B.fit(df, NAMES, "y", "id", B.BoostParams(**settings, trees_per_stage=7, rows_per_task=1600))
    assert (one.feature == many.feature).all() and (one.threshold == many.threshold).all()
    assert many.value == pytest.approx(one.value)


def test_histograms_of_bundles_and_siblings(rows):
    _, x, y = rows
    cuts = [np.unique(x[:, i])[:-1].tolist() for i in range(6)]
    grower = B._Grower(cuts, B.BoostParams(), lambda a: a)
    assert len(grower.bundles) < 6
    code, joint = grower.codes(x)
    grower.load(code, joint, y, np.arange(len(y), dtype=np.uint64))
    node, drawn = np.arange(len(y)) % 4, np.arange(len(y)) % 5 > 0
    small = np.array([1, 0])
    got = grower._histograms(node, drawn, y, small)
    for parent in range(2):
        here = drawn & (node == 2 * parent + small[parent])
        for f in range(6):
            at = slice(grower.begin[f], grower.begin[f] + grower.sizes[f])
            assert got[0, parent, at] == pytest.approx(np.bincount(code[f][here], weights=y[here], minlength=grower.sizes[f]))
            assert got[1, parent, at].tolist() == np.bincount(code[f][here], minlength=grower.sizes[f]).tolist()


def test_rounds_learn_as_well_as_trees_one_after_another(rows):
    _, x, y = rows
    cuts = [np.unique(x[:, i])[:-1].tolist() for i in range(6)]
    held_out, errors = np.arange(3000) % 5 == 0, []
    for at_once in (True, False):
        p = B.BoostParams(max_depth=4, at_once=10 if at_once else 1)
        grower = B._Grower(cuts, p, lambda a: a)
        grower.load(*grower.codes(x[~held_out]), y[~held_out], np.arange((~held_out).sum(), dtype=np.uint64))
        margin, trees = np.full((~held_out).sum(), y[~held_out].mean()), []
        for begin in range(0, 200, p.at_once):
            trees += grower.grow(list(range(begin, begin + p.at_once)), margin.copy(), margin)
        m = B.BoostedTrees(y[~held_out].mean(), *[np.array([t[i] for t in trees]) for i in range(3)])
        errors.append(((y - m.predict(x))[held_out] ** 2).mean())
    assert errors[0] < 1.1 * errors[1]


def test_attribution_of_a_batch_is_that_of_its_rows(spark, rows):
    df, x, _ = rows
    m = B.fit(df, NAMES, "y", "id", B.BoostParams(max_iter=3, max_depth=5))
    worker = B.Attributor(B.leaf_paths(m), x[:3], 6)
    assert max(len(t) for t in worker.twigs) == 4 and sum(len(t) for t in worker.twigs) == len(worker.paths.value)
    got = worker.batch(x[:700])  # more than one block
    assert got.sum(axis=0) == pytest.approx(m.predict(x[:700])[:, None] - m.predict(x[:3])[None])
    for i in (0, 511, 512, 699):
        assert got[:, i] == pytest.approx(worker.impacts(x[i]).T)
