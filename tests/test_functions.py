"""Scalar functions: the source's unit cases (FIXTURES A) and our boundary rows (FIXTURES C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylens.functions import amenities, derive, labels, parse, text


def one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


class TestParsePrice:
    def test_dollar_sign_removed(self, spark):
        assert one(spark, ["$150.00"], parse.parse_price) == [150.0]

    def test_comma_removed(self, spark):
        assert one(spark, ["$1,200.00"], parse.parse_price) == [1200.0]

    def test_plain_number(self, spark):
        assert one(spark, ["75"], parse.parse_price) == [75.0]

    def test_invalid_returns_null(self, spark):
        assert one(spark, ["N/A", "not a price", ""], parse.parse_price) == [None, None, None]

    def test_negative_price_parsed(self, spark):
        assert one(spark, ["-50"], parse.parse_price) == [-50.0]

    def test_series(self, spark):
        assert one(spark, ["$100", "$1,500.50", "N/A", None], parse.parse_price) == [100.0, 1500.5, None, None]

    def test_boundaries(self, spark):
        # euro sign, 1.5d and inf are rejected; inner spaces and exponents accepted
        assert one(spark, ["€10", "1.5d", "inf", "NaN", "1 200", "1e3"], parse.parse_price) == [
            None, None, None, None, 1200.0, 1000.0]


class TestParseDate:
    def test_iso(self, spark):
        assert one(spark, ["2023-01-15"], parse.parse_date) == [dt.date(2023, 1, 15)]

    def test_invalid(self, spark):
        assert one(spark, ["not-a-date", "9999-99-99", ""], parse.parse_date) == [None, None, None]

    def test_null(self, spark):
        assert one(spark, [None], parse.parse_date) == [None]

    def test_other_shapes(self, spark):
        assert one(spark, ["2023", "15/02/2023"], parse.parse_date) == [None, None]


class TestRoomType:
    def test_canonical(self, spark):
        assert one(spark, ["Entire home/apt"], labels.normalize_room_type) == ["Entire home/apt"]

    def test_case_variants(self, spark):
        got = one(spark, ["entire home/apt", "PRIVATE ROOM", "Shared Room"], labels.normalize_room_type)
        assert got == ["Entire home/apt", "Private room", "Shared room"]

    def test_hotel(self, spark):
        assert one(spark, ["Hotel room"], labels.normalize_room_type) == ["Hotel room"]

    def test_unknown_title_case_and_null(self, spark):
        got = one(spark, ["entire villa/bed's", None], labels.normalize_room_type)
        assert got == ["Entire Villa/Bed'S", None]

    def test_unknown_listed(self, spark):
        df = spark.createDataFrame([("x room",), ("Private room",), ("x room",), (None,)], "room_type string")
        assert [r[0] for r in labels.unknown_room_types(df).collect()] == ["x room"]


class TestAmenities:
    def test_json(self, spark):
        got = one(spark, ['["Wifi", "Kitchen", "Air conditioning"]'], parse.parse_amenities)[0]
        assert "Wifi" in got and "Kitchen" in got

    def test_empty_and_null(self, spark):
        assert one(spark, ["", None], parse.parse_amenities) == [[], []]

    def test_single(self, spark):
        assert len(one(spark, ['["Wifi"]'], parse.parse_amenities)[0]) == 1

    def test_brace_form_and_broken_json(self, spark):
        got = one(spark, ['{TV,"Hot tub", ,Wifi}', '["Wifi", "Kit'], parse.parse_amenities)
        assert got == [["TV", "Hot tub", "Wifi"], []]

    def test_flags_exact_case_insensitive(self, spark):
        df = spark.createDataFrame([(["WIFI"],), (["Wifi 6"],), ([None, "Pool"],), (None,)], "amenities_list array<string>")
        out = amenities.with_amenity_flags(df).select("has_wifi", "has_pool").collect()
        assert [tuple(r) for r in out] == [(True, False), (False, False), (False, True), (False, False)]


class TestPropertyType:
    def test_apartment(self, spark):
        assert one(spark, ["Entire apartment"], labels.normalize_property_type) == ["Apartment"]

    def test_unknown(self, spark):
        assert one(spark, ["Some weird unknown type xyz"], labels.normalize_property_type) == ["Other"]

    def test_house_and_null(self, spark):
        assert one(spark, ["Entire house", None], labels.normalize_property_type) == ["House", "Other"]


class TestTextAndDerive:
    def test_na_tokens(self, spark):
        got = one(spark, ["N/A", "NA", "null", "NaN", "None", "n/a", "#N/A", "<NA>", "", " nan", "ok"], text.na_to_null)
        assert got == [None] * 9 + [" nan", "ok"]

    def test_title_case_matches_python(self, spark):
        vals = ["entire home/apt", "bed's and b&b", "ÉCOLE privée", "x2y"]
        assert one(spark, vals, text.title_case) == [v.title() for v in vals]

    def test_round2_matches_numpy(self, spark):
        import numpy as np

        vals = [0.125, 2.675, 1.005, 2.5, -1.115] + [i / 7.0 for i in range(1, 3000)]
        got = one(spark, vals, derive.round2, "double")
        assert got == [float(np.round(v, 2)) for v in vals]

    def test_price_per_bedroom_order(self, spark):
        df = spark.createDataFrame([(100.0, None), (100.0, 0.0), (100.0, 3.0)], "price double, bedrooms double")
        got = [r[0] for r in df.select(derive.price_per_bedroom("price", "bedrooms")).collect()]
        assert got == [None, 100.0, 33.33]

    def test_calendar_parts(self, spark):
        df = spark.createDataFrame([(dt.date(2024, 6, 1),), (None,)], "d date")
        rows = df.select(*[c.alias(k) for k, c in derive.calendar_parts("d").items()]).collect()
        assert tuple(rows[0]) == (True, "Saturday", 6, 2024)
        assert rows[1][0] is False

    def test_bool_decode(self, spark):
        vals = ["t", "f", "True", "y", "1", None]
        assert one(spark, vals, parse.decode_bool) == [True, False, True, None, None, None]
        assert one(spark, vals, parse.decode_calendar_bool) == [True, False, None, None, None, None]

    def test_comment_clean(self, spark):
        assert one(spark, ["  hi ", "nan", "None", None], text.clean_comment) == ["hi", None, None, None]
        assert one(spark, ["abc", None], text.text_length) == [3, 0]

    def test_tenure(self, spark):
        df = spark.createDataFrame([(dt.date(2020, 6, 1),)], "d date")
        assert df.select(derive.tenure_years("d", "2024-06-01")).first()[0] == round(1461 / 365.25, 2)


def test_common_shapes_skip_the_slow_path(spark):
    texts = ["12", " 12\n", "12.0", "+7", "007", "-0", "1.", ".5", "1e400", "NaN", "1.5d", "0x1p3", "$1,234.50", "-$5", "$ 5", "\x0112", "12\u0085",
             "2024-02-29", "2023-02-29", "0000-01-01", "2024-01-1 ", "12024-1-01", "\t2024-01-01 ", "9223372036854775808", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1:] for r in df.select("t", parse.safe_long("t"), parse.safe_double("t"), parse.parse_price("t"), parse.parse_date("t").cast("string")).collect()}
    assert got["12"] == got[" 12\n"] == got["12.0"] == (12, 12.0, 12.0, None)
    assert got["+7"][0] == got["007"][0] == 7 and got["-0"][0] == 0 and got["1."] == (1, 1.0, 1.0, None) and got[".5"] == (None, 0.5, 0.5, None)
    assert got["$1,234.50"][2] == 1234.5 and got["-$5"][2] == -5.0 and got["$ 5"][2] == 5.0
    assert got["2024-02-29"][3] == "2024-02-29" and got["\t2024-01-01 "][3] == "2024-01-01" and got["0000-01-01"][3] == "0000-01-01"
    for t in ("1e400", "NaN", "1.5d", "0x1p3", "\x0112", "2023-02-29", "2024-01-1 ", "12024-1-01", "", None):
        assert got[t] == (None, None, None, None), t
    assert got["9223372036854775808"][0] is None and got["12\u0085"] == (12, None, None, None)
    plan = df.select(*derive.calendar_parts(parse.parse_date("t")).values(), text.strip_ws("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan and "CASE WHEN" in plan
