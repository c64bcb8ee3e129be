"""Gold star schema (PRJ-1, AGG-10, FLT-5, JOB-7): projections of silver tables.

Marts are narrow projections, so Catalyst prunes the Parquet scan to exactly
the listed columns. ``dim_hosts`` is the only shuffle (a DISTINCT over the
host attributes, partially aggregated map-side). ``fact_calendar`` is written
partitioned by (year, month) so date predicates prune partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.values import AMENITY_FLAGS
from staylens.sources.snapshots import Folders

REVIEW_SCORES = [
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
]

DIM_LISTINGS = (
    [("id", "listing_id"), ("name", "listing_name")]
    + [(c, c) for c in ["description", "neighborhood_overview", "picture_url", "property_type", "property_type_std",
                        "room_type", "accommodates", "bathrooms_text", "bathrooms", "bedrooms", "beds", "amenities",
                        "amenity_count"]]
    + [(c, c) for c in AMENITY_FLAGS]
    + [(c, c) for c in ["price", "minimum_nights", "maximum_nights", "number_of_reviews"]]
    + [(c, c) for c in REVIEW_SCORES]
    + [("instant_bookable", "instant_bookable"), ("host_id", "host_id")]
)

DIM_HOSTS = [
    "host_id", "host_name", "host_since", "host_location", "host_about", "host_response_time",
    "host_response_rate", "host_acceptance_rate", "host_is_superhost", "host_neighbourhood",
    "host_listings_count", "host_total_listings_count", "host_verifications", "host_has_profile_pic",
    "host_identity_verified", "is_commercial_host", "host_tenure_years",
]

DIM_GEOGRAPHY = [
    ("id", "listing_id"),
    ("neighbourhood_cleansed", "neighbourhood"),
    ("neighbourhood_group_cleansed", "neighbourhood_group"),
    ("latitude", "latitude"),
    ("longitude", "longitude"),
]

FACT_CALENDAR = [
    "listing_id", "date", "available", "price", "adjusted_price", "minimum_nights", "maximum_nights",
    "is_weekend", "day_of_week", "month", "year",
]

FACT_REVIEWS = [
    ("listing_id", "listing_id"), ("id", "review_id"), ("date", "date"), ("reviewer_id", "reviewer_id"),
    ("reviewer_name", "reviewer_name"), ("comments", "comments"), ("comment_length", "comment_length"),
]


def _rename(df: DataFrame, pairs) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in pairs])


def dim_listings(listings: DataFrame) -> DataFrame:
    return _rename(listings, DIM_LISTINGS)


def dim_hosts(listings: DataFrame, one_row_per_host: bool = False) -> DataFrame:
    """DISTINCT host attribute rows with a host id (T7: a host may have several rows).

    ``one_row_per_host`` keeps the row of the latest ``host_since`` per host (ties: the
    largest by the other columns in order) by a partially aggregated ``max``.
    """
    hosts = listings.select(*DIM_HOSTS).where(F.col("host_id").isNotNull())
    if not one_row_per_host:
        return hosts.distinct()
    others = [c for c in DIM_HOSTS if c != "host_id"]
    picked = hosts.groupBy("host_id").agg(F.max(F.struct(F.col("host_since").alias("__latest"), *others)).alias("h"))
    return picked.select("host_id", *[F.col(f"h.{c}").alias(c) for c in others])


def dim_geography(listings: DataFrame) -> DataFrame:
    return _rename(listings, DIM_GEOGRAPHY)


def fact_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.select(*FACT_CALENDAR)


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return _rename(reviews, FACT_REVIEWS)


#: The silver table each mart is made from.
MADE_FROM = {"dim_listings": "listings", "dim_hosts": "listings", "dim_geography": "listings", "fact_calendar": "calendar", "fact_reviews": "reviews"}


def build_marts(listings_valid: DataFrame, calendar: DataFrame, reviews: DataFrame) -> dict[str, DataFrame]:
    """JOB-7 in dependency order; staging is the silver frames themselves."""
    return {
        "dim_listings": dim_listings(listings_valid),
        "dim_hosts": dim_hosts(listings_valid),
        "dim_geography": dim_geography(listings_valid),
        "fact_calendar": fact_calendar(calendar),
        "fact_reviews": fact_reviews(reviews),
    }


def write_marts(marts: dict[str, DataFrame], base: str, store=Folders) -> dict[str, str]:
    """SNK-3: materialize marts as Parquet tables; the calendar fact is date-partitioned.

    With ``store=Snapshots`` each mart is committed as a version of its table."""
    paths = {}
    for name, df in marts.items():
        path = f"{base.rstrip('/')}/{name}"
        if name == "fact_calendar":
            # AQE rebalances rows by (year, month): few files per folder, and a hot
            # month is split over several tasks instead of landing in one.
            paths[name] = store.save(df.hint("rebalance", "year", "month"), path, ["year", "month"])
        else:
            paths[name] = store.save(df, path)
    return paths
