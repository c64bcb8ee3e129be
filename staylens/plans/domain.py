"""Rental-market views over the driver tables.

The driver tables are a clean star schema; the rental domain needs listings,
a calendar, reviews, and raw landed text. Each stand-in attribute is a
deterministic expression of driver columns. The attribute formulas are kept as
portable SQL text (``ATTR_*``) so the DuckDB oracle derives the *inputs*
identically, while every column the library itself derives (labels, tenure,
flags, rounding, quality rules, ...) is computed by the library in Spark and
written independently in the oracle SQL.

Scale notes: ``orders x customer`` is a shuffle join on the customer key (both
sides grow with the data); ``nation`` (25 rows by schema definition) is
broadcast after a bounded row-count check. ``lineitem`` and ``events`` are read with their needed columns
only, and no view shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import derive, labels
from staylens.sources.tables import read_table, spread

AS_OF = "2024-06-01"
CITY_BOUNDS = {"lat_min": 51.2, "lat_max": 51.8, "lon_min": -0.6, "lon_max": 0.4}

# Raw listing attributes: k = o_orderkey (listing), h = c_custkey (host).
ATTR_LISTINGS = {
    "id": "o_orderkey",
    "name": "'Listing ' || CAST(o_orderkey AS STRING)",
    "description": "c_mktsegment",
    "neighborhood_overview": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Close to ' || n_name END",
    "picture_url": "'img/' || CAST(o_orderkey AS STRING) || '.jpg'",
    "property_type": (
        "CASE o_orderkey % 9 WHEN 0 THEN 'Entire apartment' WHEN 1 THEN 'Private room in house' "
        "WHEN 2 THEN 'Entire house' WHEN 3 THEN 'entire loft ' WHEN 4 THEN 'Room in boutique hotel' "
        "WHEN 5 THEN 'Boat' WHEN 6 THEN 'Entire villa' WHEN 7 THEN 'Castle' ELSE NULL END"
    ),
    "room_type": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Entire home/apt' WHEN '2-HIGH' THEN 'Private room' "
        "WHEN '3-MEDIUM' THEN 'Entire home/apt' WHEN '4-NOT SPECIFIED' THEN 'Shared room' ELSE 'Hotel room' END"
    ),
    "accommodates": "CAST(o_orderkey % 8 + 1 AS DOUBLE)",
    "bathrooms_text": "CAST(o_orderkey % 3 + 1 AS STRING) || ' baths'",
    "bathrooms": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 3 + 1 AS DOUBLE) END",
    "bedrooms": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS DOUBLE) END",
    "beds": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 4 + 1 AS DOUBLE) END",
    "amenities": "'amenity-set-' || CAST(o_orderkey % 60 AS STRING)",
    "amenity_count": "CAST(o_orderkey % 60 AS INT)",
    "has_wifi": "o_orderkey % 2 = 0",
    "has_kitchen": "o_orderkey % 3 <> 0",
    "has_parking": "o_orderkey % 5 = 0",
    "has_ac": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 3 = 0 END",
    "has_washer": "o_orderkey % 4 <> 0",
    "has_tv": "o_orderkey % 7 <> 0",
    "has_elevator": "o_orderkey % 6 = 0",
    "has_pool": "o_orderkey % 50 = 0",
    "has_gym": "o_orderkey % 8 = 0",
    "has_hot_tub": "o_orderkey % 40 = 0",
    "has_breakfast": "o_orderkey % 9 = 0",
    "is_pet_friendly": "o_orderkey % 11 = 0",
    "has_long_term_stays": "o_orderkey % 2 = 1",
    "has_self_checkin": "o_orderkey % 5 <> 1",
    "price": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 2 - 2000) AS DOUBLE) / 100 END",
    "minimum_nights": "CAST(o_orderkey % 1130 AS DOUBLE)",
    "maximum_nights": "CAST(o_orderkey % 1130 + 30 AS DOUBLE)",
    "availability_365": "CAST(o_orderkey % 370 - 1 AS DOUBLE)",
    "number_of_reviews": "CAST(o_orderkey % 97 AS DOUBLE)",
    "review_scores_rating": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 45 AS DOUBLE) / 10 END",
    "review_scores_accuracy": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 37 AS DOUBLE) / 10 END",
    "review_scores_cleanliness": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 39 AS DOUBLE) / 10 END",
    "review_scores_checkin": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 33 AS DOUBLE) / 10 END",
    "review_scores_communication": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 35 AS DOUBLE) / 10 END",
    "review_scores_location": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 31 AS DOUBLE) / 10 END",
    "review_scores_value": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + CAST(o_orderkey % 29 AS DOUBLE) / 10 END",
    "instant_bookable": "o_orderkey % 4 = 0",
    "last_review": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    "host_id": "o_custkey",
    "host_name": "c_name",
    "host_since": "DATE '1995-01-01' + CAST(c_custkey % 11000 AS INT)",
    "host_location": "n_name",
    "host_about": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END",
    "host_response_time": (
        "CASE c_custkey % 4 WHEN 0 THEN 'within an hour' WHEN 1 THEN 'within a few hours' "
        "WHEN 2 THEN 'within a day' ELSE NULL END"
    ),
    "host_response_rate": "CAST(c_custkey % 101 AS STRING) || '%'",
    "host_acceptance_rate": "CAST((c_custkey * 7) % 101 AS STRING) || '%'",
    "host_is_superhost": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal > 5000 END",
    "host_neighbourhood": "n_name",
    "host_listings_count": "CAST(c_custkey % 5 AS DOUBLE)",
    "host_total_listings_count": "CAST(c_custkey % 5 + c_custkey % 3 AS DOUBLE)",
    "host_verifications": "CASE WHEN c_custkey % 2 = 0 THEN 'email,phone' ELSE 'phone' END",
    "host_has_profile_pic": "CASE WHEN c_custkey % 10 = 0 THEN 'f' ELSE 't' END",
    "host_identity_verified": "c_custkey % 3 <> 0",
    "calculated_host_listings_count": "CAST(c_custkey % 5 AS DOUBLE)",
    "neighbourhood_cleansed": "n_name",
    "neighbourhood_group_cleansed": "'Region ' || CAST(n_regionkey AS STRING)",
    "latitude": "51.15 + CAST(o_orderkey % 700 AS DOUBLE) / 1000",
    "longitude": "-0.65 + CAST(o_orderkey % 1100 AS DOUBLE) / 1000",
}

ATTR_CALENDAR = {
    "listing_id": "l_orderkey",
    "date": "CAST(l_shipdate AS DATE)",
    "available": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus = 'O' END",
    "price": (
        "CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN 0.0 "
        "ELSE l_extendedprice / 100 END"
    ),
    "adjusted_price": "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_extendedprice / 100 END",
    "minimum_nights": "CAST(l_linenumber AS DOUBLE)",
    "maximum_nights": "l_quantity",
}

ATTR_REVIEWS = {
    "listing_id": (
        "CASE event_type WHEN 'view' THEN CAST(1 AS BIGINT) WHEN 'click' THEN CAST(2 AS BIGINT) "
        "WHEN 'error' THEN CAST(3 AS BIGINT) WHEN 'purchase' THEN CAST(4 AS BIGINT) ELSE CAST(5 AS BIGINT) END"
    ),
    "id": "event_id",
    "date": "CAST(ts AS DATE)",
    "reviewer_id": "user_id",
    "reviewer_name": "'user_' || CAST(user_id AS STRING)",
    "comments": (
        "CASE WHEN event_id % 17 = 0 THEN 'nan' WHEN event_id % 19 = 0 THEN 'None' "
        "WHEN event_id % 23 = 0 THEN NULL ELSE '  ' || props || ' ' END"
    ),
}

# Raw landed text for the parsing operators (one row per order / part).
ATTR_RAW_LISTINGS = {
    "id": "o_orderkey",
    "price_text": (
        "CASE WHEN o_orderkey % 29 = 0 THEN 'N/A' WHEN o_orderkey % 31 = 0 THEN 'not a price' "
        "WHEN o_orderkey % 37 = 0 THEN '-' || CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS STRING) "
        "WHEN o_orderkey % 5 = 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) "
        "ELSE '$' || CAST(CAST(floor(CAST(floor(o_totalprice) AS BIGINT) / 1000) AS BIGINT) AS STRING) || ',' || "
        "lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0') || '.50' END"
    ),
    "date_text": (
        "CASE WHEN o_orderkey % 13 = 0 THEN 'not-a-date' WHEN o_orderkey % 17 = 0 THEN '9999-99-99' "
        "WHEN o_orderkey % 19 = 0 THEN CAST(year(o_orderdate) AS STRING) "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"
    ),
    "room_type_text": (
        "CASE o_orderkey % 7 WHEN 0 THEN 'entire home/apt' WHEN 1 THEN 'PRIVATE ROOM' WHEN 2 THEN 'Shared Room' "
        "WHEN 3 THEN 'Hotel room' WHEN 4 THEN ' Entire home ' WHEN 5 THEN 'entire villa/bed''s' ELSE NULL END"
    ),
    "bool_text": (
        "CASE o_orderkey % 6 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN 'True' WHEN 3 THEN 'y' "
        "WHEN 4 THEN '1' ELSE NULL END"
    ),
    "number_text": (
        "CASE WHEN o_orderkey % 11 = 0 THEN '1.5d' WHEN o_orderkey % 13 = 0 THEN 'NaN' "
        "WHEN o_orderkey % 17 = 0 THEN '1e3' WHEN o_orderkey % 19 = 0 THEN '' "
        "ELSE CAST(o_orderkey % 1000 AS STRING) || '.25' END"
    ),
    "na_text": (
        "CASE o_orderkey % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN 'NA' WHEN 2 THEN 'null' WHEN 3 THEN 'None' "
        "WHEN 4 THEN '' WHEN 5 THEN ' nan' ELSE o_orderpriority END"
    ),
}

ATTR_RAW_AMENITIES = {
    "id": "p_partkey",
    "amenities_text": (
        "CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '[\"Wifi\", \"Kit' "
        "WHEN p_partkey % 2 = 0 THEN '[\"' || replace(p_name, ' ', '\", \"') || '\", \"Wifi\"]' "
        "ELSE '{' || replace(p_name, ' ', ',\"') || '\", ,Pool,TV}' END"
    ),
}


def _project(df: DataFrame, attrs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in attrs.items()])


def listing_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer x nation with only the columns the attributes need."""
    o = spread(read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    ))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def listings(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Typed listings as the silver step leaves them (flags not yet applied)."""
    df = _project(listing_base(spark, sf_dir), ATTR_LISTINGS)
    return df.withColumns(
        {
            "property_type_std": labels.normalize_property_type("property_type"),
            "host_tenure_years": derive.tenure_years("host_since", as_of),
            "days_since_last_review": derive.days_since("last_review", as_of),
            "price_per_bedroom": derive.price_per_bedroom("price", "bedrooms"),
            "is_commercial_host": derive.commercial_host("calculated_host_listings_count"),
        }
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_linestatus", "l_extendedprice", "l_quantity"
    ))
    df = _project(li, ATTR_CALENDAR)
    return df.withColumns(derive.calendar_parts("date"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props"))
    return _project(ev, ATTR_REVIEWS)


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"))
    return _project(o, ATTR_RAW_LISTINGS)


def raw_amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(read_table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    return _project(p, ATTR_RAW_AMENITIES)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hypothetical property per customer (the whole table)."""
    c = spread(read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        *[F.expr(e).alias(k) for k, e in ATTR_REQUESTS.items()])


ATTR_REQUESTS = {
    "request_id": "c_custkey",
    "borough": "n_name",
    "room_type": (
        "CASE c_custkey % 4 WHEN 0 THEN 'Entire home/apt' WHEN 1 THEN 'Private room' "
        "WHEN 2 THEN 'Shared room' ELSE 'Hotel room' END"
    ),
    "bedrooms": "CAST(c_custkey % 6 AS DOUBLE)",
    "bathrooms": "CAST(c_custkey % 3 + 1 AS DOUBLE)",
    "accommodates": "CAST(c_custkey % 8 + 1 AS DOUBLE)",
    "beds": "CAST(c_custkey % 4 + 1 AS DOUBLE)",
    "amenity_count": "CAST(c_custkey % 60 AS INT)",
    "has_wifi": "c_custkey % 2 = 0",
    "has_kitchen": "c_custkey % 3 <> 0",
    "has_parking": "c_custkey % 5 = 0",
    "has_ac": "c_custkey % 3 = 0",
    "has_washer": "c_custkey % 4 <> 0",
    "has_tv": "c_custkey % 7 <> 0",
    "has_elevator": "c_custkey % 6 = 0",
    "has_pool": "c_custkey % 50 = 0",
    "has_gym": "c_custkey % 8 = 0",
    "has_hot_tub": "c_custkey % 40 = 0",
    "has_breakfast": "c_custkey % 9 = 0",
    "is_pet_friendly": "c_custkey % 11 = 0",
    "has_self_checkin": "c_custkey % 5 <> 1",
}
