"""Join operators (JOIN-4, JOIN-6, JOIN-7, AGG-16, FLT-6).

Comparables (JOIN-4 + WIN-5 + SRT-4): the source runs one parameterized query
per request. Here a whole request table is answered at once, exactly, without
enumerating all (request, listing) pairs:

1. Candidates: listings in the price range are reduced to the best ``k`` per
   (area, room type, bedrooms) -- within one bedroom value the order is
   (reviews desc, listing_id), so the top ``k`` of each value is all any
   request can use. ``row_number() <= k`` gets a partial WindowGroupLimit
   before the shuffle, so even a group holding a third of all listings sends
   at most ``k`` rows per map task.
2. Requests join the candidates on the equi keys (area, room type, whole number
   of bedrooms): a request looks into its own number and both neighbours, and
   the exact distance is a residual predicate (hash / sort-merge join, never a
   nested loop). Each request meets at most ``k`` x (distinct bedroom values)
   candidates, a bound independent of the table size.
3. ``row_number() <= k`` per request by (distance, reviews desc, listing_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.operators.windows import top_n


def comparable_candidates(listings: DataFrame, geography: DataFrame, k: int = 5,
                          price_range=(10, 2000)) -> DataFrame:
    lo, hi = price_range
    l = listings.where(F.col("price").between(lo, hi)).select(
        "listing_id", "listing_name", "room_type", "price", "number_of_reviews", "review_scores_rating", "accommodates",
        F.coalesce(F.col("bedrooms"), F.lit(1.0)).alias("bedrooms"),
        F.coalesce(F.col("bathrooms"), F.lit(1.0)).alias("bathrooms"),
    )
    order = [F.col("number_of_reviews").desc_nulls_last(), F.col("listing_id").asc()]
    # A listing id copied many times could multiply the join; only the best k
    # copies per (id, room type, bedrooms) and k area rows per (id, area) can
    # reach any top k, so both sides are bounded per id before the join.
    l = top_n(l, ["listing_id", "room_type", "bedrooms"], order, k, "__r").drop("__r")
    g = geography.select("listing_id", F.col("neighbourhood").alias("borough"))
    g = top_n(g, ["listing_id", "borough"], [F.col("borough")], k, "__r").drop("__r")
    j = l.join(g, "listing_id")
    return top_n(j, ["borough", "room_type", "bedrooms"], order, k, "cand_rank").drop("cand_rank")


def comparables(requests: DataFrame, listings: DataFrame, geography: DataFrame, k: int = 5,
                request_id: str = "request_id") -> DataFrame:
    """Top ``k`` comparables per request: same area and room type, |bedrooms diff| <= 1."""
    cand = comparable_candidates(listings, geography, k)
    req = requests.select(
        F.col(request_id).alias("request_id"), F.col("borough").alias("req_borough"),
        F.col("room_type").alias("req_room_type"), F.col("bedrooms").alias("req_bedrooms"),
    )
    whole = F.floor("req_bedrooms")
    req = req.withColumn("req_whole", F.explode(F.array(whole - 1, whole, whole + 1)))
    dist = F.abs(F.col("bedrooms") - F.col("req_bedrooms"))
    cond = (
        (F.floor("bedrooms") == F.col("req_whole"))
        & (F.col("borough") == F.col("req_borough"))
        & (F.col("room_type") == F.col("req_room_type"))
        & (dist <= 1)
    )
    pairs = req.join(cand, cond).withColumn("bedroom_distance", dist)
    order = [F.col("bedroom_distance").asc(), F.col("number_of_reviews").desc_nulls_last(), F.col("listing_id").asc()]
    ranked = top_n(pairs, ["request_id"], order, k, "comp_rank")
    return ranked.select(
        "request_id", "comp_rank", "listing_id", "listing_name", "borough", "room_type", "bedrooms", "bathrooms",
        "accommodates", "price", "number_of_reviews", "review_scores_rating", "bedroom_distance",
    )


def comparable_summary(comps: DataFrame, predictions: DataFrame | None = None, mae: Column | float | None = None) -> DataFrame:
    """AGG-16: average comparable price per request; optionally whether the
    prediction lies within +-MAE of it."""
    s = comps.groupBy("request_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_comparables"), F.avg("price").alias("comparable_avg_price")
    )
    if predictions is None:
        return s
    m = mae if isinstance(mae, Column) else F.lit(mae)
    j = s.join(predictions.select("request_id", "predicted_price"), "request_id")
    return j.withColumn("within_mae", F.abs(F.col("predicted_price") - F.col("comparable_avg_price")) < m)


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, value: str, fallback: Column,
                        default: float) -> DataFrame:
    """JOIN-7: left lookup; missing -> ``fallback`` (e.g. the selected area's
    value) -> constant ``default``."""
    j = df.join(lookup.select(key, F.col(value).alias("__v")), key, "left")
    return j.withColumn(value, F.coalesce(F.col("__v"), fallback, F.lit(default))).drop("__v")


def per_label_rows(requests: DataFrame, labels: list[str], column: str) -> DataFrame:
    """JOIN-6: each request once per label of a fitted encoder.

    The label list belongs to the model (its size is the encoder's vocabulary,
    known and bounded when the model is fitted), so the expansion is a
    ``explode`` of a literal array -- no join at all.
    """
    return requests.withColumn(column, F.explode(F.array(*[F.lit(x) for x in labels])))


def single_request(spark, borough: str, room_type: str, bedrooms: float, request_id: int = 0) -> DataFrame:
    """FLT-6: one parameterized request as a one-row request table (bound values,
    no SQL text assembly), so the same batch operator answers it."""
    return spark.createDataFrame(
        [(request_id, borough, room_type, float(bedrooms))],
        "request_id long, borough string, room_type string, bedrooms double",
    )


def display_comparables(comps: DataFrame, symbol: str = "£") -> DataFrame:
    """PRJ-8: presentation columns of the comparables table."""
    from staylens.functions import format as fmt

    return comps.select(
        F.col("request_id"), F.col("comp_rank"),
        F.col("listing_name").alias("Listing Name"), F.col("borough").alias("Borough"),
        F.col("room_type").alias("Room Type"), F.col("bedrooms").alias("Beds"), F.col("bathrooms").alias("Baths"),
        F.col("accommodates").alias("Guests"), fmt.money0("price", symbol).alias("Price/night"),
        F.col("number_of_reviews").alias("Reviews"), fmt.one_decimal_or_na("review_scores_rating").alias("Rating"),
    )
