import pytest

from staylens.operators import model as ml
from staylens.operators import registry
from staylens.plans import queries as Q

SF = "/root/testdata/sf0.001"
FEW = ml.GBTParams(max_iter=2, max_depth=3)


def test_one_fit_a_version_also_across_sessions(spark, tmp_dir):
    fits = []

    def train():
        fits.append(1)
        return ml.train_price_model(Q.feature_table(spark, SF), FEW)

    a = registry.model(tmp_dir, "x", "v1", FEW, train)
    assert registry.model(tmp_dir, "x", "v1", FEW, train) is a
    registry._loaded.clear()  # as a new session that shares the folder
    b = registry.model(tmp_dir, "x", "v1", FEW, lambda: pytest.fail("fitted again"))
    assert (a.model.trees.value == b.model.trees.value).all() and a.boroughs == b.boroughs and a.metrics == b.metrics
    registry.model(tmp_dir, "x", "v2", FEW, train)
    registry.model(tmp_dir, "x", "v2", ml.GBTParams(max_iter=3, max_depth=3), lambda: ml.train_price_model(Q.feature_table(spark, SF), ml.GBTParams(max_iter=3, max_depth=3)))
    assert len(fits) == 2
    found = registry.entries(spark, tmp_dir).collect()
    assert sorted((r.input_version, r.trees) for r in found) == [("v1", 2), ("v2", 2), ("v2", 3)]


def test_a_fit_that_comes_second_loads_the_first(spark, tmp_dir, monkeypatch):
    first = ml.train_price_model(Q.feature_table(spark, SF), FEW)
    first.metrics["mae"] = 123.0
    save = ml.save_model

    def other_session_commits(tm, path, meta=None):
        save(first, path, meta)
        base = None  # this session still builds on the state it saw: no version
        from staylens.sources import snapshots

        monkeypatch.setattr(snapshots, "current", lambda s, t, real=snapshots.current: None if t == path and base is None and not done else real(s, t))
        try:
            return save(tm, path, meta)
        finally:
            done.append(1)

    done = []
    monkeypatch.setattr(ml, "save_model", other_session_commits)
    got = registry.model(tmp_dir, "x", "v", FEW, lambda: ml.train_price_model(Q.feature_table(spark, SF), FEW))
    assert got.metrics["mae"] == 123.0
