"""Silver cleaning jobs (JOB-2 .. JOB-6) as lazy DataFrame chains.

Each ``clean_*`` takes a raw (all-string) frame, returns a typed frame and
triggers no action; column-presence guards run on the driver over
``df.columns`` only. ``run_silver`` writes the outputs; every dataset is
isolated (one failure does not stop the others) and logged as an event.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import amenities, derive, labels, parse, text
from staylens.operators import quality
from staylens.operators.windows import keep_first
from staylens.sources.snapshots import Folders

PRICE_COLS = ["price", "weekly_price", "monthly_price", "security_deposit", "cleaning_fee"]
DATE_COLS = ["host_since", "last_review", "calendar_last_scraped", "first_review"]
NUMERIC_COLS = [
    "accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights", "maximum_nights",
    "availability_30", "availability_60", "availability_90", "availability_365",
    "number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_l30d",
    "calculated_host_listings_count", "reviews_per_month",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_location", "review_scores_value",
    # location and host counts are numeric in the typed source as well
    "latitude", "longitude", "host_listings_count", "host_total_listings_count",
]
ID_COLS = ["id", "host_id"]
BOOL_COLS = ["host_is_superhost", "host_identity_verified", "has_availability", "instant_bookable"]
#: Datasets a city may come without; a missing file of any other one is a failure.
OPTIONAL = {"neighbourhoods"}
FILL_ONE = {"bedrooms": 1.0, "beds": 1.0, "bathrooms": 1.0}


@dataclass
class CityConfig:
    """Typed city settings (replaces the YAML loader)."""

    name: str = "london"
    bounds: dict = field(default_factory=lambda: {"lat_min": 51.2, "lat_max": 51.8, "lon_min": -0.6, "lon_max": 0.4})
    latest_date: str | None = None


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def type_listings(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """Parse, normalize, cast and derive (steps before validation), one projection per step group."""
    df = raw
    parsed = {c: parse.parse_price(c) for c in _present(df, PRICE_COLS)}
    parsed.update({c: parse.parse_date(c) for c in _present(df, DATE_COLS)})
    if "room_type" in df.columns:
        parsed["room_type"] = labels.normalize_room_type("room_type")
    if "property_type" in df.columns:
        parsed["property_type_std"] = labels.normalize_property_type("property_type")
    if "amenities" in df.columns:
        parsed["amenities_list"] = parse.parse_amenities("amenities")
    parsed.update({c: parse.safe_double(c) for c in _present(df, NUMERIC_COLS)})
    parsed.update({c: parse.safe_long(c) for c in _present(df, ID_COLS)})
    parsed.update({c: parse.decode_bool(c) for c in _present(df, BOOL_COLS)})
    df = df.withColumns(parsed)
    if "amenities_list" in df.columns:
        df = df.withColumn("amenity_count", amenities.amenity_count("amenities_list"))
        df = amenities.with_amenity_flags(df, "amenities_list")
    derived = {}
    if "host_since" in df.columns:
        derived["host_tenure_years"] = derive.tenure_years("host_since", as_of)
    if "last_review" in df.columns:
        derived["days_since_last_review"] = derive.days_since("last_review", as_of)
    if "price" in df.columns and "bedrooms" in df.columns:
        # T4: before bedrooms are defaulted, so unknown bedrooms keep a null ratio.
        derived["price_per_bedroom"] = derive.price_per_bedroom("price", "bedrooms")
    if "calculated_host_listings_count" in df.columns:
        derived["is_commercial_host"] = derive.commercial_host("calculated_host_listings_count")
    df = df.withColumns(derived)
    return derive.fill_defaults(df, FILL_ONE)


def clean_listings(raw: DataFrame, city: CityConfig, as_of: str | None = None) -> DataFrame:
    """JOB-2: typed + flagged listings (all rows; ``is_valid`` marks the clean subset)."""
    typed = type_listings(raw, as_of)
    return quality.apply_flags(typed, quality.listing_rules(city.bounds, as_of))


def clean_calendar(raw: DataFrame) -> DataFrame:
    """JOB-3: invalid rows are kept; only flags are added."""
    df = raw
    cast = {}
    if "date" in df.columns:
        cast["date"] = parse.parse_date("date")
    if "available" in df.columns:
        cast["available"] = parse.decode_calendar_bool("available")
    cast.update({c: parse.parse_price(c) for c in _present(df, ["price", "adjusted_price"])})
    cast.update({c: parse.safe_double(c) for c in _present(df, ["minimum_nights", "maximum_nights"])})
    if "listing_id" in df.columns:
        cast["listing_id"] = parse.safe_long("listing_id")
    df = df.withColumns(cast)
    if "date" in df.columns:
        df = df.withColumns(derive.calendar_parts("date"))
    return quality.apply_flags(df, quality.calendar_rules())


def type_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews with cleaned comments, before deduplication."""
    df = raw
    cast = {}
    if "date" in df.columns:
        cast["date"] = parse.parse_date("date") if dict(df.dtypes)["date"] == "string" else F.col("date")
    if "comments" in df.columns:
        cast["comments"] = text.clean_comment("comments")
    for c in _present(df, ["listing_id", "reviewer_id", "id"]):
        if dict(df.dtypes)[c] == "string":
            cast[c] = parse.safe_long(c)
    df = df.withColumns(cast)
    if "comments" in df.columns:
        df = df.withColumn("comment_length", text.text_length("comments"))
    return df


def clean_reviews(raw: DataFrame) -> DataFrame:
    """JOB-4: typed reviews, deduplicated on (listing, reviewer, date)."""
    df = type_reviews(raw)
    keys = _present(df, ["listing_id", "reviewer_id", "date"])
    return keep_first(df, keys, order_col="id") if keys else df


def clean_neighbourhoods(raw: DataFrame) -> DataFrame:
    """JOB-5: standard column names, text kept as is."""
    return text.standardize_columns(raw)


def write_listings(flagged: DataFrame, silver_dir: str, store=Folders) -> dict:
    """SNK-2: write all rows with flags, then the valid subset read back from that write.

    Reading the written table (instead of caching) keeps the two sinks
    consistent, is lineage-free for the second write, and survives executor loss.
    """
    full = store.save(flagged, f"{silver_dir.rstrip('/')}/listings_full.parquet")
    written = flagged.sparkSession.read.schema(flagged.schema).parquet(full)
    return {"full": full, "clean": store.save(quality.valid_subset(written), f"{silver_dir.rstrip('/')}/listings.parquet")}


def run_silver(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    silver_dir: str,
    city: CityConfig,
    as_of: str | None = None,
    log=None,
    store=Folders,
    same: frozenset[str] | set[str] = frozenset(),
) -> dict[str, dict]:
    """JOB-6: clean each dataset independently; a failure is recorded, the rest continue.

    With ``store=Snapshots`` every dataset is committed as a version of its table: a
    failed one leaves its table as it was, and readers never see half of a write.
    The datasets ``same`` are unchanged since they were last cleaned: their tables stay.
    """
    from staylens.sources import metadata

    summary: dict[str, dict] = {}
    events = []
    steps = {
        "listings": lambda r: write_listings(clean_listings(r, city, as_of), silver_dir, store)["clean"],
        "calendar": lambda r: _write(clean_calendar(r), silver_dir, "calendar", store),
        "reviews": lambda r: _write(clean_reviews(r), silver_dir, "reviews", store),
        "neighbourhoods": lambda r: _write(clean_neighbourhoods(r), silver_dir, "neighbourhoods", store),
    }

    def run_one(name, step):
        if name in same:
            summary[name] = {"status": "skipped"}
            events.append(metadata.event(city.name, "silver", f"{name}.parquet", "skipped"))
            return
        if raw.get(name) is None:
            if name not in OPTIONAL:
                summary[name] = {"status": "failed", "error": f"no {name} file"}
                events.append(metadata.event(city.name, "silver", f"{name}.parquet", "failed", error_message=f"no {name} file"))
            return
        t0 = time.time()
        try:
            path = step(raw[name])
            rows = spark.read.parquet(path).count()
            dur = round(time.time() - t0, 2)
            summary[name] = {"status": "success", "rows": rows, "path": path}
            events.append(metadata.event(city.name, "silver", f"{name}.parquet", "success", file_path=path,
                                         row_count=rows, duration_sec=dur))
        except Exception as e:  # isolate datasets from each other
            summary[name] = {"status": "failed", "error": str(e)}
            events.append(metadata.event(city.name, "silver", f"{name}.parquet", "failed", error_message=str(e)))

    # the datasets are independent jobs: submitted concurrently, each isolated
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for f in [pool.submit(run_one, n, st) for n, st in steps.items()]:
            f.result()
    if log is not None:
        metadata.append_events(spark, log, events)
    return summary


def _write(df: DataFrame, silver_dir: str, name: str, store=Folders) -> str:
    return store.save(df, f"{silver_dir.rstrip('/')}/{name}.parquet")
