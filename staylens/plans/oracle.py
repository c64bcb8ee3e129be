"""DuckDB SQL for the correctness gate: the same views and queries, written
independently in SQL (only the stand-in attribute formulas are shared text).

Conventions (SURVEY 7.3): row-level two-decimal values use
``round_even(x * 100, 0) / 100`` (pandas rounding); aggregate doubles are
rounded on both sides to 9 decimals and then to 4 (``r4``), which absorbs
last-bit differences from summation order;
counts are BIGINT; date parts INTEGER.
"""

from __future__ import annotations

from staylens.plans import domain
from staylens.plans.oracle_values import AMENITY_FLAGS, PROPERTY_TYPE_GROUPS, ROOM_TYPE_LABELS

AS_OF = domain.AS_OF
B = domain.CITY_BOUNDS


def r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def r4(x: str) -> str:
    return f"(round_even(round_even(({x}) * 1000000000.0, 0) / 1000000000.0 * 10000.0, 0) / 10000.0)"


def _select(attrs: dict[str, str]) -> str:
    return ",\n    ".join(f"{e} AS {n}" for n, e in attrs.items())


def _case_map(key: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {key} {whens} ELSE NULL END)"


def property_std_sql(c: str) -> str:
    return f"COALESCE({_case_map(f'lower(trim({c}))', PROPERTY_TYPE_GROUPS)}, 'Other')"


def title_sql(c: str) -> str:
    parts = f"regexp_extract_all(lower({c}), '(\\pL+|[^\\pL]+)', 1)"
    return f"(CASE WHEN {c} IS NULL THEN NULL ELSE array_to_string(list_transform({parts}, lambda x: upper(x[1]) || x[2:]), '') END)"


def room_type_sql(c: str) -> str:
    return f"COALESCE({_case_map(f'lower(trim({c}))', ROOM_TYPE_LABELS)}, {title_sql(c)})"


V_LISTINGS = f"""
v_listings_raw AS (
  SELECT
    {_select(domain.ATTR_LISTINGS)}
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
v_listings AS (
  SELECT *,
    {property_std_sql('property_type')} AS property_type_std,
    {r2(f"CAST(date_diff('day', host_since, DATE '{AS_OF}') AS DOUBLE) / 365.25")} AS host_tenure_years,
    CAST(date_diff('day', last_review, DATE '{AS_OF}') AS INTEGER) AS days_since_last_review,
    {r2("price / CASE WHEN bedrooms < 1 THEN 1.0 ELSE bedrooms END")} AS price_per_bedroom,
    COALESCE(calculated_host_listings_count > 1, false) AS is_commercial_host
  FROM v_listings_raw
),
v_flagged AS (
  SELECT *,
    flag_valid_price AND flag_valid_lat AND flag_valid_lon AND flag_valid_min_nights
      AND flag_valid_availability AND flag_valid_rating AND flag_valid_id AND flag_valid_host_since AS is_valid
  FROM (
    SELECT *,
      COALESCE(price > 0, false) AS flag_valid_price,
      COALESCE(latitude BETWEEN {B['lat_min']} AND {B['lat_max']}, false) AS flag_valid_lat,
      COALESCE(longitude BETWEEN {B['lon_min']} AND {B['lon_max']}, false) AS flag_valid_lon,
      COALESCE(minimum_nights BETWEEN 1 AND 1125, false) AS flag_valid_min_nights,
      COALESCE(availability_365 BETWEEN 0 AND 365, false) AS flag_valid_availability,
      COALESCE(review_scores_rating BETWEEN 0 AND 5, true) AS flag_valid_rating,
      id IS NOT NULL AS flag_valid_id,
      COALESCE(host_since <= DATE '{AS_OF}', true) AS flag_valid_host_since
    FROM v_listings
  ) f
),
v_valid AS (SELECT * FROM v_flagged WHERE is_valid),
dim_listings AS (
  SELECT id AS listing_id, name AS listing_name, description, neighborhood_overview, picture_url, property_type,
    property_type_std, room_type, accommodates, bathrooms_text, bathrooms, bedrooms, beds, amenities, amenity_count,
    {", ".join(AMENITY_FLAGS)},
    price, minimum_nights, maximum_nights, number_of_reviews, review_scores_rating, review_scores_accuracy,
    review_scores_cleanliness, review_scores_checkin, review_scores_communication, review_scores_location,
    review_scores_value, instant_bookable, host_id
  FROM v_valid
),
dim_hosts AS (
  SELECT DISTINCT host_id, host_name, host_since, host_location, host_about, host_response_time,
    host_response_rate, host_acceptance_rate, host_is_superhost, host_neighbourhood, host_listings_count,
    host_total_listings_count, host_verifications, host_has_profile_pic, host_identity_verified,
    is_commercial_host, host_tenure_years
  FROM v_valid WHERE host_id IS NOT NULL
),
dim_geography AS (
  SELECT id AS listing_id, neighbourhood_cleansed AS neighbourhood, neighbourhood_group_cleansed AS neighbourhood_group,
    latitude, longitude
  FROM v_valid
)"""

V_CALENDAR = f"""
v_calendar_raw AS (
  SELECT
    {_select(domain.ATTR_CALENDAR)}
  FROM lineitem
),
v_calendar AS (
  SELECT *,
    COALESCE(isodow(date) >= 6, false) AS is_weekend,
    dayname(date) AS day_of_week,
    CAST(month(date) AS INTEGER) AS month,
    CAST(year(date) AS INTEGER) AS year,
    COALESCE(price > 0, true) AS flag_valid_price,
    available IS NOT NULL AS flag_valid_available,
    COALESCE(price > 0, true) AND available IS NOT NULL AS is_valid
  FROM v_calendar_raw
),
fact_calendar AS (
  SELECT listing_id, date, available, price, adjusted_price, minimum_nights, maximum_nights,
    is_weekend, day_of_week, month, year
  FROM v_calendar
)"""

V_REVIEWS = f"""
v_reviews_raw AS (
  SELECT
    {_select(domain.ATTR_REVIEWS)}
  FROM events
),
v_reviews_typed AS (
  SELECT listing_id, id, date, reviewer_id, reviewer_name,
    CASE WHEN comments IS NULL OR trim(comments) IN ('nan', 'None') THEN NULL ELSE trim(comments) END AS comments
  FROM v_reviews_raw
),
v_reviews AS (
  SELECT listing_id, id, date, reviewer_id, reviewer_name, comments, CAST(COALESCE(length(comments), 0) AS INTEGER) AS comment_length
  FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id, reviewer_id, date ORDER BY id NULLS LAST) AS rn
    FROM v_reviews_typed
  ) t WHERE rn = 1
),
fact_reviews AS (
  SELECT listing_id, id AS review_id, date, reviewer_id, reviewer_name, comments, comment_length FROM v_reviews
)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",".join(v.strip("\n") for v in views) + "\n" + body


def L(body: str) -> str:
    return with_views(body, V_LISTINGS)


def LC(body: str) -> str:
    return with_views(body, V_LISTINGS, V_CALENDAR)


def LCR(body: str) -> str:
    return with_views(body, V_LISTINGS, V_CALENDAR, V_REVIEWS)


def C(body: str) -> str:
    return with_views(body, V_CALENDAR)


def R(body: str) -> str:
    return with_views(body, V_REVIEWS)
