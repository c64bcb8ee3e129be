"""One check per semantic trap T1..T19 and the empty-input rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylens.functions import derive, labels, parse, text
from staylens.operators import aggregates as agg
from staylens.operators import quality, windows
from staylens.plans import gold


def col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_t1_na_tokens(spark):
    got = [r[0] for r in col(spark, ["NA", "#N/A", "NULL", "x"]).select(text.na_to_null("v")).collect()]
    assert got == [None, None, None, "x"]


def test_t2_ansi_safe(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = col(spark, ["N/A", "x"])
    # no exception under ANSI: every coercion is try_* behind a guard
    assert [r[0] for r in df.select(parse.safe_double("v"), ).collect()] == [None, None]
    assert df.select(parse.parse_date("v")).collect()[0][0] is None
    assert spark.range(1).select(derive.safe_ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_t3_no_nan_or_suffix(spark):
    got = [r[0] for r in col(spark, ["1.5d", "1f", "NaN", "inf", "2.5"]).select(parse.safe_double("v")).collect()]
    assert got == [None, None, None, None, 2.5]


def test_t4_ratio_before_fill(spark):
    from staylens.plans import silver

    raw = spark.createDataFrame([("1", "$100", None)], "id string, price string, bedrooms string")
    out = silver.type_listings(raw, "2024-06-01").first()
    assert out.price_per_bedroom is None and out.bedrooms == 1.0


def test_t5_title_case(spark):
    got = col(spark, ["entire home/apt x", "shared-space"]).select(labels.normalize_room_type("v")).collect()
    assert [r[0] for r in got] == ["Entire Home/Apt X", "Shared-Space"]


def test_t6_two_valued(spark):
    df = spark.createDataFrame([(None, None)], "c double, d date")
    r = df.select(derive.commercial_host("c"), derive.weekend("d")).first()
    assert tuple(r) == (False, False)


def test_t7_host_rows_distinct(spark):
    rows = [(1, "a", dt.date(2020, 1, 1), True), (1, "a", dt.date(2020, 1, 1), False), (1, "a", dt.date(2020, 1, 1), False)]
    df = spark.createDataFrame(rows, "host_id long, host_name string, host_since date, host_is_superhost boolean")
    for c in gold.DIM_HOSTS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    assert gold.dim_hosts(df).count() == 2
    assert gold.dim_hosts(df, one_row_per_host=True).count() == 1


def test_t8_keep_first_by_id(spark):
    df = spark.createDataFrame([(1, 9), (1, 3), (1, 5)], "k long, id long")
    assert windows.keep_first(df, ["k"], "id").first().id == 3


def test_t9_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2.0,), (1.0,)], "x double")
    asc = [r[0] for r in df.orderBy(F.col("x").asc_nulls_last()).collect()]
    desc = [r[0] for r in df.orderBy(F.col("x").desc_nulls_last()).collect()]
    assert asc == [1.0, 2.0, None] and desc == [2.0, 1.0, None]


def test_t10_sample_before_filter(spark):
    from staylens.operators import sampling

    df = spark.range(0, 1000).withColumnRenamed("id", "listing_id").withColumn("price", F.col("listing_id") * 1.0)
    s = sampling.hash_sample(df, "listing_id", 100).where(F.col("price") < 500)
    assert s.count() < 100  # the filter applies to the sample, not before it


def test_t11_pvalue_without_scipy():
    from staylens.operators import stats

    assert stats.t_two_sided_p(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)


def test_t12_records_not_lines(spark, tmp_dir):
    import os

    from staylens.sources import landing

    p = os.path.join(tmp_dir, "r.csv")
    with open(p, "w") as f:
        f.write('a,b\n1,"x\ny\nz"\n2,w\n')
    assert landing.file_record_counts(spark, [p]).first().row_count == 2


def test_t13_min_nights_1125(spark):
    rules = {r.name: r for r in quality.listing_rules({"lat_min": 0, "lat_max": 1, "lon_min": 0, "lon_max": 1})}
    assert "1125" in rules["valid_minimum_nights"].description


def test_t14_iso_only(spark):
    got = [r[0] for r in col(spark, ["2023", "2023-02-30", "2023-02-28"]).select(parse.parse_date("v")).collect()]
    assert got == [None, None, dt.date(2023, 2, 28)]


def test_t15_as_of_parameter(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    assert df.select(derive.days_since("d", "2024-01-11")).first()[0] == 10


def test_t16_explicit_types(spark):
    out = agg.kpis(spark.createDataFrame([(1.0, 2.0)], "price double, number_of_reviews double"))
    assert dict(out.dtypes)["total_listings"] == "bigint"
    parts = spark.createDataFrame([(dt.date(2024, 6, 1),)], "d date").select(*derive.calendar_parts("d").values())
    assert [t for _, t in parts.dtypes] == ["boolean", "string", "int", "int"]


def test_t17_full_day_name(spark):
    d = spark.createDataFrame([(dt.date(2024, 6, 1),)], "d date")
    assert d.select(derive.calendar_parts("d")["day_of_week"]).first()[0] == "Saturday"


def test_t18_null_items(spark):
    from staylens.functions import amenities

    df = spark.createDataFrame([([None],)], "amenities_list array<string>")
    assert amenities.with_amenity_flags(df).first().has_wifi is False


def test_t19_round2(spark):
    got = [r[0] for r in col(spark, [0.125, 2.675], "double").select(derive.round2("v")).collect()]
    assert got == [0.12, 2.68]


def test_empty_inputs_give_nulls_not_errors(spark):
    e = spark.createDataFrame([], "price double, number_of_reviews double, has_ac boolean, room_type string")
    k = agg.kpis(e).first()
    assert k.total_listings == 0 and k.avg_price is None
    assert agg.conditional_means(e, {"ac": "has_ac"}).first().ac_premium is None
    assert agg.histogram(e, "price").count() == 0
    cal = spark.createDataFrame([], "listing_id long, available boolean")
    geo = spark.createDataFrame([], "listing_id long, neighbourhood string")
    assert agg.occupancy_by_area(cal, geo).count() == 0
    assert agg.profile(e, ["price"]).where("metric = 'mean'").first().value is None
