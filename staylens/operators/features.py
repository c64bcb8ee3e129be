"""Model feature table and encodings (ML-1, ML-2, PRJ-6, SCL-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.derive import coalesce_defaults
from staylens.functions.values import TRAIN_PRICE_RANGE

BOOL_FEATURES = [
    "has_wifi", "has_kitchen", "has_parking", "has_ac", "has_washer", "has_tv", "has_elevator",
    "has_pool", "has_gym", "has_hot_tub", "has_breakfast", "is_pet_friendly", "has_self_checkin",
]
NUMERIC_DEFAULTS = {"bedrooms": 1.0, "bathrooms": 1.0, "accommodates": 2.0, "beds": 1.0, "amenity_count": 0}
FEATURE_COLS = [
    "room_type_enc", "bedrooms", "bathrooms", "accommodates", "beds", "amenity_count", "neighbourhood_enc",
    *BOOL_FEATURES,
]


def training_listings(listings: DataFrame, price_range=TRAIN_PRICE_RANGE) -> DataFrame:
    """FLT-2: price in range (inclusive, so null drops out) and room type known."""
    lo, hi = price_range
    return listings.where(F.col("price").between(lo, hi) & F.col("room_type").isNotNull())


def feature_table(listings: DataFrame, geography: DataFrame, price_range=TRAIN_PRICE_RANGE) -> DataFrame:
    """ML-1: listings x geography, query-time defaults, price in range, room type known."""
    l = training_listings(listings, price_range)
    j = l.join(geography.select("listing_id", "neighbourhood"), "listing_id")
    defaults = coalesce_defaults(NUMERIC_DEFAULTS)
    defaults.update({b: F.coalesce(F.col(b), F.lit(False)).cast("int") for b in BOOL_FEATURES})
    return j.select("listing_id", "price", "room_type", "neighbourhood", *[v.alias(k) for k, v in defaults.items()])
