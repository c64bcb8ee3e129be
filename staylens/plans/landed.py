"""Land the domain views as a city's raw export (gzip CSV + plain CSV).

Used by the ingestion queries and the end-to-end tests: the files are
written by Spark from the driver tables into the shared store, in the text
shapes the silver step must parse (``$1,234.50`` prices, ``t``/``f``
booleans, JSON amenity lists, ISO dates, quoted multi-line comments).
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.values import AMENITY_FLAGS
from staylens.plans import domain

TEXT_LISTING_COLS = [
    "id", "name", "description", "neighborhood_overview", "picture_url", "host_id", "host_name", "host_since",
    "host_location", "host_about", "host_response_time", "host_response_rate", "host_acceptance_rate",
    "host_is_superhost", "host_neighbourhood", "host_listings_count", "host_total_listings_count",
    "host_verifications", "host_has_profile_pic", "host_identity_verified", "neighbourhood_cleansed",
    "neighbourhood_group_cleansed", "latitude", "longitude", "property_type", "room_type", "accommodates",
    "bathrooms", "bathrooms_text", "bedrooms", "beds", "amenities", "price", "minimum_nights", "maximum_nights",
    "availability_365", "number_of_reviews", "last_review", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value", "instant_bookable", "calculated_host_listings_count",
]


#: Real exports have 18-digit ids; the landed text has them too, one apart, so that
#: an id that passed through double would meet its neighbour.
ID_BASE = 549_880_000_000_000_000


def _long_id(name: str) -> F.Column:
    return (F.col(name).cast("long") + F.lit(ID_BASE)).alias(name)


def _money(c) -> F.Column:
    return F.when(c.isNotNull(), F.concat(F.lit("$"), F.format_number(c, 2)))


def _plain_money(c) -> F.Column:
    """Full precision (the calendar stand-in prices carry 4 decimals)."""
    return F.when(c.isNotNull(), F.concat(F.lit("$"), c.cast("string")))


def _tf(c) -> F.Column:
    return F.when(c, F.lit("t")).when(~c, F.lit("f"))


def raw_listing_text(spark: SparkSession, sf: str) -> DataFrame:
    typed = domain.listings(spark, sf)
    names = F.array(*[F.when(F.coalesce(F.col(f), F.lit(False)), F.lit(n[0])) for f, n in AMENITY_FLAGS.items()])
    amen = F.to_json(F.filter(names, lambda x: x.isNotNull()))
    out = []
    types = dict(typed.dtypes)
    for c in TEXT_LISTING_COLS:
        col = F.col(c)
        if c == "id":
            e = _long_id("id").cast("string")
        elif c == "price":
            e = _money(col)
        elif c == "amenities":
            e = amen
        elif types[c] == "boolean":
            e = _tf(col)
        else:
            e = col.cast("string")
        out.append(e.alias(c))
    return typed.select(*out)


def raw_review_text(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews as exported: 18-digit ids, some comments of two lines with quotes."""
    return domain.raw_reviews(spark, sf).select(
        _long_id("listing_id"), _long_id("id"), F.col("date").cast("string").alias("date"), "reviewer_id", "reviewer_name",
        F.when(F.col("id") % 29 == 0, F.concat(F.col("comments"), F.lit("\nsecond line, with \"quotes\"")))
        .otherwise(F.col("comments")).alias("comments"),
    )


def land_plain_reviews(spark: SparkSession, sf: str, folder: str) -> str:
    """Reviews as plain CSV files with quoted line ends."""
    raw_review_text(spark, sf).write.option("header", True).option("quote", '"').option("escape", '"').csv(folder)
    return folder


DATASETS = ("listings", "calendar", "reviews", "neighbourhoods")
#: Writer options of the landed text: the fast level, as compressing takes most of the time.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def land(spark: SparkSession, sf: str, folder: str, partitions: int | None = None, names: Iterable[str] = DATASETS) -> dict[str, str]:
    """Write listings / calendar / reviews (gzip CSV) and neighbourhoods (CSV).

    Only the datasets ``names`` are written. Each one keeps its natural partitioning (one file per task); pass
    ``partitions`` only to shape small test fixtures.
    """
    opts = {"header": True, "quote": '"', "escape": '"'}
    paths = {}
    cal = domain.calendar(spark, sf).select(
        _long_id("listing_id"), F.col("date").cast("string").alias("date"), _tf(F.col("available")).alias("available"),
        _plain_money(F.col("price")).alias("price"), _plain_money(F.col("adjusted_price")).alias("adjusted_price"),
        F.col("minimum_nights").cast("string").alias("minimum_nights"),
        F.col("maximum_nights").cast("string").alias("maximum_nights"),
    )
    rev = raw_review_text(spark, sf)
    nb = domain.listing_base(spark, sf).select(
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("Neighbourhood Group"),
        F.col("n_name").alias("Neighbourhood"),
    ).distinct()
    def write(name, df, comp):
        path = f"{folder.rstrip('/')}/{name}"
        out = df.coalesce(partitions) if partitions else df
        w = out.write.mode("overwrite").options(**opts)
        if comp:
            w = w.options(**GZIP)
        w.csv(path)
        paths[name] = path

    frames = {"listings": raw_listing_text(spark, sf), "calendar": cal, "reviews": rev, "neighbourhoods": nb}
    datasets = [(n, frames[n], n != "neighbourhoods") for n in names]
    # independent jobs: submitted concurrently from driver threads
    with ThreadPoolExecutor(max_workers=len(datasets)) as pool:
        for f in [pool.submit(write, *d) for d in datasets]:
            f.result()
    return paths
