"""Maintained state: landings give what one pass over everything gives."""

import datetime as dt
import random

from pyspark.sql import functions as F

from staylens.operators import aggregates, occupancy_state
from staylens.sources import snapshots

DAY = "listing_id long, date date, available boolean, year int, month int"


def calendar(spark, rows):
    df = spark.createDataFrame(rows, "listing_id long, date date, available boolean")
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def days(seed, n, months=6):
    r = random.Random(seed)
    out = [(r.choice([1, 2, 3, 77, 77, 77, None]), dt.date(2024, r.randint(1, months), r.randint(1, 28)), r.choice([True, False, None])) for _ in range(n)]
    return out + [(5, None, False)]


def test_landings_equal_one_pass(spark, tmp_dir):
    table = f"{tmp_dir}/state"
    parts = [days(1, 300), days(2, 50, months=2), days(3, 200)]
    geo = spark.createDataFrame([(1, "a"), (2, "a"), (77, "b"), (3, "c"), (3, "c"), (5, "c")], "listing_id long, neighbourhood string")
    versions = [occupancy_state.land(calendar(spark, p), table) for p in parts]
    got = occupancy_state.occupancy(snapshots.read(spark, table), geo)
    want = aggregates.occupancy_by_area(calendar(spark, sum(parts, [])), geo)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the second landing had days of two months (and one without a date): the others keep their folders
    kept = [m for m in versions[0].parts if versions[1].parts[m] == versions[0].parts[m]]
    assert sorted(kept) == ["2024-03", "2024-04", "2024-05", "2024-06"]
    assert occupancy_state.land(calendar(spark, []), table).version == versions[-1].version


def test_keep_first_over_landings(spark, tmp_dir):
    from staylens.operators import keepfirst_state as state
    from staylens.operators.windows import keep_first

    r = random.Random(4)
    cols = "a long, b string, id long, text string"
    parts = [[(r.choice([1, 2, 3, None]), r.choice(["x", "y", None]), r.choice([None, *range(40)]), r.choice("pqr")) for _ in range(60)] for _ in range(4)]
    parts.append([(9, "hot", i, "t") for i in range(300)])
    frames = [spark.createDataFrame(p, cols) for p in parts]
    every = spark.createDataFrame(sum(parts, []), cols)
    want = sorted(map(str, keep_first(every, ["a", "b"]).collect()))
    for n, order in enumerate(([0, 1, 2, 3, 4], [4, 2, 2, 0, 3, 1], [3, 1, 0, 4, 2, 0])):
        table = f"{tmp_dir}/kept{n}"
        for i in order:
            state.land(frames[i], table, ["a", "b"], buckets=7)
        assert sorted(map(str, state.kept_rows(spark, table).collect())) == want


def test_keep_first_replaces_only_changed_buckets(spark, tmp_dir):
    from staylens.operators import keepfirst_state as state

    table = f"{tmp_dir}/kept"
    assert state.land(spark.createDataFrame([], "k long, id long"), table, ["k"]) is None
    first = state.land(spark.range(100).selectExpr("id AS k", "id + 10 AS id"), table, ["k"], buckets=16)
    assert state.land(spark.range(100).selectExpr("id AS k", "id + 11 AS id"), table, ["k"]).version == first.version  # nothing comes before
    second = state.land(spark.createDataFrame([(5, 1), (6, 99)], "k long, id long"), table, ["k"])
    assert len(first.parts) > 10 and sum(first.parts[b] != second.parts[b] for b in first.parts) == 1
    assert {tuple(x) for x in state.kept_rows(spark, table).where("k in (5, 6)").collect()} == {(5, 1), (6, 16)}


def test_uniqueness_over_landings(spark, tmp_dir):
    from staylens.operators import uniqueness_state as state

    r = random.Random(6)
    parts = [[r.choice([None, *range(500)]) for _ in range(n)] for n in (300, 5, 400, 0, 300)] + [[7] * 200]
    seen: list = []
    for p in parts:
        got = state.land(spark.createDataFrame([(x, "other") for x in p], "id long, key string"), f"{tmp_dir}/ids", "id", buckets=4)
        seen += p
        assert (got["rows"], got["distinct"], got["failed"]) == (len(seen), len(set(seen)), len(seen) - len(set(seen)))
    # the look-up reads only parts whose filter may hold a key
    filters = snapshots.read(spark, f"{tmp_dir}/ids/filters")
    assert filters.count() <= 4 * len(parts) and filters.where("bucket is null").count() == 0


def test_filters_hold_all_their_keys_and_few_others():
    import numpy as np
    import pyarrow as pa

    from staylens.operators import uniqueness_state as state

    h = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 20_000)
    one = state._build(pa.table({"part": ["a"] * 10_000, "bucket": pa.array([0] * 10_000, pa.int32()), "hash": h[:10_000]}))
    hit = set(state._maybe(pa.table({"hash": h}), one).column("hash").to_pylist())
    assert hit >= set(h[:10_000].tolist()) and len(hit - set(h[:10_000].tolist())) < 300


def test_a_landing_moves_each_state_row_once(spark):
    rows = [(n, 2024, 1 + n % 3, 1, n % 2) for n in range(300)] + [(7, 2024, 2, 5, 1), (None, None, None, 1, 0)]
    state = spark.createDataFrame(rows, "listing_id long, year int, month int, days long, booked long")
    dealt = occupancy_state._dealt(state)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = sorted(map(str, dealt.drop("period").collect()))
    assert got == sorted(map(str, occupancy_state.merged(state).collect()))
    # a month's rows are dealt over its slices
    held = dealt.where("period = '2024-02'").select(F.pmod(F.xxhash64("listing_id"), F.lit(occupancy_state.SLICES)).alias("s")).distinct().count()
    assert held == occupancy_state.SLICES
