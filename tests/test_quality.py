"""Data-quality rules at their boundaries and with nulls (FIXTURES C, DQ rows)."""

import datetime as dt

from pyspark.sql import functions as F

from staylens.operators import quality

BOUNDS = {"lat_min": 51.2, "lat_max": 51.8, "lon_min": -0.6, "lon_max": 0.4}
SCHEMA = ("id long, price double, latitude double, longitude double, minimum_nights double, "
          "availability_365 double, review_scores_rating double, host_since date")
AS_OF = "2024-06-01"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def good(**kw):
    base = dict(id=1, price=10.0, latitude=51.5, longitude=0.0, minimum_nights=2.0, availability_365=10.0,
                review_scores_rating=4.5, host_since=dt.date(2020, 1, 1))
    base.update(kw)
    return tuple(base.values())


def flags(spark, rows, flag):
    f = quality.apply_flags(frame(spark, rows), quality.listing_rules(BOUNDS, AS_OF))
    return [r[0] for r in f.orderBy("id").select(flag).collect()]


def test_price(spark):
    rows = [good(id=i, price=p) for i, p in enumerate([0.0, -1.0, None, 0.01])]
    assert flags(spark, rows, "flag_valid_price") == [False, False, False, True]


def test_latitude_inclusive(spark):
    rows = [good(id=i, latitude=v) for i, v in enumerate([51.2, 51.8, 51.19, None])]
    assert flags(spark, rows, "flag_valid_lat") == [True, True, False, False]


def test_min_nights(spark):
    rows = [good(id=i, minimum_nights=v) for i, v in enumerate([0.0, 1.0, 1125.0, 1126.0])]
    assert flags(spark, rows, "flag_valid_min_nights") == [False, True, True, False]


def test_availability(spark):
    rows = [good(id=i, availability_365=v) for i, v in enumerate([-1.0, 0.0, 365.0, 366.0])]
    assert flags(spark, rows, "flag_valid_availability") == [False, True, True, False]


def test_rating_null_passes(spark):
    rows = [good(id=i, review_scores_rating=v) for i, v in enumerate([None, 0.0, 5.0, 5.1])]
    assert flags(spark, rows, "flag_valid_rating") == [True, True, True, False]


def test_host_since(spark):
    d = dt.date(2024, 6, 1)
    rows = [good(id=i, host_since=v) for i, v in enumerate([d, d + dt.timedelta(days=1), None])]
    assert flags(spark, rows, "flag_valid_host_since") == [True, False, True]


def test_report_unique_and_composite(spark):
    rows = [good(id=1), good(id=1), good(id=None), good(id=None, price=0.0), good(id=2)]
    f = quality.apply_flags(frame(spark, rows), quality.listing_rules(BOUNDS, AS_OF))
    rep = {r.rule: r for r in quality.rule_report(f, quality.listing_rules(BOUNDS, AS_OF)).collect()}
    # pandas duplicated(): 2nd id=1 and 2nd null are duplicates
    assert rep["unique_listing_id"].failed == 2
    assert rep["valid_listing_id"].failed == 2
    assert rep["valid_price"].failed == 1 and rep["valid_price"].pct_failed == 20.0
    assert rep["is_valid"].failed == 2
    # unique rule sets no flag and does not affect is_valid
    assert "flag_valid_unique" not in f.columns
    s = quality.validity_summary(f).first()
    assert (s.total_records, s.total_valid, s.total_invalid, s.pct_valid) == (5, 3, 2, 60.0)


def test_empty_report_has_null_pct(spark):
    f = quality.apply_flags(frame(spark, []), quality.listing_rules(BOUNDS, AS_OF))
    rep = quality.rule_report(f, quality.listing_rules(BOUNDS, AS_OF)).collect()
    assert all(r.pct_failed is None and r.failed == 0 for r in rep)


def test_missing_column_skips_rule(spark):
    df = spark.createDataFrame([(1, 5.0)], "id long, price double")
    f = quality.apply_flags(df, quality.listing_rules(BOUNDS, AS_OF))
    assert [c for c in f.columns if c.startswith("flag_")] == ["flag_valid_price", "flag_valid_id"]


def test_calendar_rules(spark):
    df = spark.createDataFrame([(None, True), (0.0, True), (5.0, None)], "price double, available boolean")
    f = quality.apply_flags(df, quality.calendar_rules())
    got = [tuple(r) for r in f.select("flag_valid_price", "flag_valid_available", "is_valid").collect()]
    assert got == [(True, True, True), (False, True, False), (True, False, False)]


def test_two_way_sink_counts_agree(spark, tmp_dir):
    from staylens.plans import silver

    rows = [good(id=i, price=float(i % 3)) for i in range(30)]
    f = quality.apply_flags(frame(spark, rows), quality.listing_rules(BOUNDS, AS_OF))
    paths = silver.write_listings(f, tmp_dir)
    full = spark.read.parquet(paths["full"])
    clean = spark.read.parquet(paths["clean"])
    invalid = [r for r in quality.rule_report(full, quality.listing_rules(BOUNDS, AS_OF)).collect() if r.rule == "is_valid"][0]
    assert full.count() == 30 and clean.count() == 30 - invalid.failed
    assert clean.where(~F.col("is_valid")).count() == 0
