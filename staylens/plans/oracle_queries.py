"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from staylens.plans import domain
from staylens.plans.oracle import C, L, LC, LCR, R, _select, property_std_sql, r2, r4, room_type_sql
from staylens.plans.oracle_values import AMENITY_FLAGS, CALENDAR_RULE_TEXT, LISTING_RULE_TEXT, NA_TOKENS

SQL: dict[str, str] = {}

SQL["area_prices"] = L(f"""
SELECT g.neighbourhood, {r4('AVG(l.price)')} AS avg_price, CAST(COUNT(*) AS BIGINT) AS listing_count
FROM dim_geography g JOIN dim_listings l ON g.listing_id = l.listing_id
WHERE l.price < 5000
GROUP BY g.neighbourhood
""")

SQL["kpis"] = L(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_listings,
  {r4('AVG(CASE WHEN price < 5000 THEN price END)')} AS avg_price,
  {r4('AVG(CASE WHEN price < 5000 THEN number_of_reviews END)')} AS avg_reviews
FROM dim_listings
""")

SQL["room_type_mix"] = L(f"""
SELECT room_type, CAST(COUNT(*) AS BIGINT) AS count, {r4('AVG(price)')} AS avg_price,
  {r4('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100')} AS pct
FROM dim_listings GROUP BY room_type
""")

SQL["room_type_insight"] = L(f"""
SELECT MAX(CASE WHEN r_desc = 1 THEN room_type END) AS top_label,
  {r4('MAX(CASE WHEN r_desc = 1 THEN pct END)')} AS top_pct,
  {r4('COALESCE(MAX(CASE WHEN r_asc = 1 THEN pct END), 0) + COALESCE(MAX(CASE WHEN r_asc = 2 AND n > 2 THEN pct END), 0)')}
    AS smallest_two_pct
FROM (
  SELECT room_type, c, CAST(c AS DOUBLE) / SUM(c) OVER () * 100 AS pct,
    row_number() OVER (ORDER BY c DESC, room_type ASC NULLS LAST) AS r_desc,
    row_number() OVER (ORDER BY c ASC, room_type DESC NULLS FIRST) AS r_asc,
    COUNT(*) OVER () AS n
  FROM (SELECT room_type, COUNT(*) AS c FROM dim_listings GROUP BY room_type) m
) s
""")

SQL["superhost_share"] = L(f"""
SELECT h.host_is_superhost,
  CASE WHEN h.host_is_superhost THEN 'Superhost' WHEN NOT h.host_is_superhost THEN 'Regular Host' ELSE 'Unknown' END AS label,
  CAST(COUNT(*) AS BIGINT) AS count,
  {r4('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100')} AS pct
FROM dim_listings l JOIN dim_hosts h ON l.host_id = h.host_id
GROUP BY h.host_is_superhost
""")

_AREA = """(SELECT g.neighbourhood, AVG(l.price) AS avg_price, COUNT(*) AS listing_count
  FROM dim_geography g JOIN dim_listings l ON g.listing_id = l.listing_id
  WHERE l.price < 5000 GROUP BY g.neighbourhood)"""

SQL["top_areas"] = L(f"""
SELECT neighbourhood, {r4('avg_price')} AS avg_price, CAST(listing_count AS BIGINT) AS listing_count
FROM {_AREA} a ORDER BY a.avg_price DESC, neighbourhood LIMIT 15
""")

SQL["area_spread"] = L(f"""
SELECT
  (SELECT neighbourhood FROM {_AREA} a ORDER BY avg_price DESC, neighbourhood LIMIT 1) AS highest_label,
  (SELECT {r4('MAX(avg_price)')} FROM {_AREA} a) AS highest_value,
  (SELECT neighbourhood FROM {_AREA} a ORDER BY avg_price ASC, neighbourhood LIMIT 1) AS lowest_label,
  (SELECT {r4('MIN(avg_price)')} FROM {_AREA} a) AS lowest_value,
  (SELECT {r4('MAX(avg_price) - MIN(avg_price)')} FROM {_AREA} a) AS spread
""")

SQL["sample_points"] = L("""
SELECT listing_id, latitude, longitude, price, property_type FROM (
  SELECT g.listing_id, g.latitude, g.longitude, l.price, l.property_type
  FROM dim_geography g JOIN dim_listings l ON g.listing_id = l.listing_id
  ORDER BY md5(CAST(g.listing_id AS VARCHAR) || ':42'), g.listing_id
  LIMIT 2000
) s WHERE price < 1000
""")

SQL["amenity_premium"] = L(f"""
SELECT {r4('w_ac')} AS with_ac, {r4('wo_ac')} AS without_ac, {r4('w_pool')} AS with_pool, {r4('wo_pool')} AS without_pool,
  {r4('w_gym')} AS with_gym, {r4('wo_gym')} AS without_gym,
  {r4('w_ac - wo_ac')} AS ac_premium, {r4('w_pool - wo_pool')} AS pool_premium, {r4('w_gym - wo_gym')} AS gym_premium
FROM (
  SELECT AVG(CASE WHEN has_ac THEN price END) AS w_ac, AVG(CASE WHEN NOT has_ac THEN price END) AS wo_ac,
    AVG(CASE WHEN has_pool THEN price END) AS w_pool, AVG(CASE WHEN NOT has_pool THEN price END) AS wo_pool,
    AVG(CASE WHEN has_gym THEN price END) AS w_gym, AVG(CASE WHEN NOT has_gym THEN price END) AS wo_gym
  FROM dim_listings WHERE price < 2000
) a
""")

SQL["tenure_cohorts"] = L(f"""
SELECT host_tenure_years, {r4('avg_price')} AS avg_price, {r4('avg_rating')} AS avg_rating FROM (
  SELECT h.host_tenure_years, AVG(l.price) AS avg_price, AVG(l.review_scores_rating) AS avg_rating
  FROM dim_hosts h JOIN dim_listings l ON h.host_id = l.host_id
  WHERE h.host_tenure_years IS NOT NULL AND l.price < 2000
  GROUP BY h.host_tenure_years
) c WHERE avg_price IS NOT NULL AND avg_rating IS NOT NULL
""")

SQL["occupancy"] = LC(f"""
SELECT g.neighbourhood AS borough,
  {r4('CAST(COUNT(CASE WHEN NOT fc.available THEN 1 END) AS DOUBLE) / COUNT(*)')} AS occupancy_rate,
  CAST(COUNT(DISTINCT fc.listing_id) AS BIGINT) AS listing_count
FROM fact_calendar fc JOIN dim_geography g ON fc.listing_id = g.listing_id
GROUP BY g.neighbourhood
""")

SQL["occupancy_recomputed"] = SQL["occupancy"]
SQL["occupancy_landings"] = SQL["occupancy"]

SQL["area_room_prices"] = L(f"""
SELECT g.neighbourhood AS borough, l.room_type, {r4('AVG(l.price)')} AS avg_price, CAST(COUNT(*) AS BIGINT) AS listing_count
FROM dim_listings l JOIN dim_geography g ON l.listing_id = g.listing_id
WHERE l.price BETWEEN 10 AND 2000
GROUP BY g.neighbourhood, l.room_type
""")

SQL["price_histogram"] = L(f"""
SELECT bin, {r4('lo + (bin - 1) * ((hi - lo) / 50)')} AS bin_start,
  {r4('CASE WHEN bin = 50 THEN hi ELSE lo + bin * ((hi - lo) / 50) END')} AS bin_end, count
FROM (
  SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE LEAST(floor((v - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin,
    lo, hi, CAST(COUNT(*) AS BIGINT) AS count
  FROM (
    SELECT v, MIN(v) OVER () AS lo, MAX(v) OVER () AS hi FROM (
      SELECT l.price AS v FROM dim_listings l JOIN dim_geography g ON l.listing_id = g.listing_id
      WHERE l.price IS NOT NULL AND l.price < 1000
    ) p
  ) b GROUP BY 1, 2, 3
) h
""")

SQL["category_lists"] = L("""
SELECT DISTINCT 'borough' AS category, g.neighbourhood AS value
FROM dim_listings l JOIN dim_geography g ON l.listing_id = g.listing_id
WHERE l.price BETWEEN 10 AND 2000 AND l.room_type IS NOT NULL AND g.neighbourhood IS NOT NULL
UNION ALL
SELECT DISTINCT 'room_type' AS category, l.room_type AS value
FROM dim_listings l JOIN dim_geography g ON l.listing_id = g.listing_id
WHERE l.price BETWEEN 10 AND 2000 AND l.room_type IS NOT NULL
""")

SQL["record_counts"] = LCR("""
SELECT table_name, row_count FROM (
  SELECT 'dim_listings' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM dim_listings
  UNION ALL SELECT 'fact_reviews', CAST(COUNT(*) AS BIGINT) FROM fact_reviews
  UNION ALL SELECT 'fact_calendar', CAST(COUNT(*) AS BIGINT) FROM fact_calendar
) t
UNION ALL
SELECT 'total', CAST((SELECT COUNT(*) FROM dim_listings) + (SELECT COUNT(*) FROM fact_reviews)
  + (SELECT COUNT(*) FROM fact_calendar) AS BIGINT)
""")


# dim_listings, written out: name and whether it is numeric
_DIM_LISTINGS = [
    ("listing_id", 1), ("listing_name", 0), ("description", 0), ("neighborhood_overview", 0), ("picture_url", 0), ("property_type", 0),
    ("property_type_std", 0), ("room_type", 0), ("accommodates", 1), ("bathrooms_text", 0), ("bathrooms", 1), ("bedrooms", 1), ("beds", 1),
    ("amenities", 0), ("amenity_count", 1), ("has_wifi", 0), ("has_kitchen", 0), ("has_parking", 0), ("has_ac", 0), ("has_washer", 0),
    ("has_tv", 0), ("has_elevator", 0), ("has_pool", 0), ("has_gym", 0), ("has_hot_tub", 0), ("has_breakfast", 0), ("is_pet_friendly", 0),
    ("has_long_term_stays", 0), ("has_self_checkin", 0), ("price", 1), ("minimum_nights", 1), ("maximum_nights", 1),
    ("number_of_reviews", 1), ("review_scores_rating", 1), ("review_scores_accuracy", 1), ("review_scores_cleanliness", 1),
    ("review_scores_checkin", 1), ("review_scores_communication", 1), ("review_scores_location", 1), ("review_scores_value", 1),
    ("instant_bookable", 0), ("host_id", 1),
]


def _profile_sql() -> str:
    parts = []
    for c, numeric in _DIM_LISTINGS:
        metrics = [("count", f"COUNT({c})"), ("nulls", f"COUNT(*) FILTER (WHERE {c} IS NULL)"),
                   ("distinct", f"COUNT(DISTINCT {c})")]
        if numeric:
            metrics += [("min", f"MIN({c})"), ("max", f"MAX({c})"), ("mean", f"AVG({c})"),
                        ("std", f"STDDEV_SAMP({c})"), ("zeros", f"COUNT(*) FILTER (WHERE {c} = 0)")]
            metrics += [(f"p{q:02d}", f"quantile_disc({c}, {q / 100})") for q in (5, 25, 50, 75, 95)]
        for m, e in metrics:
            parts.append(f"SELECT '{c}' AS column_name, '{m}' AS metric, {r4(f'CAST({e} AS DOUBLE)')} AS value FROM dim_listings")
    return L("\nUNION ALL\n".join(parts))


SQL["profile"] = _profile_sql()

SQL["dim_listings"] = L("SELECT * FROM dim_listings")
SQL["dim_hosts"] = L("SELECT * FROM dim_hosts")
SQL["dim_geography"] = L("SELECT * FROM dim_geography")
SQL["fact_calendar"] = C("SELECT * FROM fact_calendar")
SQL["fact_reviews"] = R("SELECT * FROM fact_reviews")

SQL["dq_listing_flags"] = L("""
SELECT id, flag_valid_price, flag_valid_lat, flag_valid_lon, flag_valid_min_nights, flag_valid_availability,
  flag_valid_rating, flag_valid_id, flag_valid_host_since, is_valid
FROM v_flagged
""")


def _report_sql(source: str, rules: list[tuple[str, str, str]], with_valid: bool) -> str:
    rows = []
    for name, desc, failed in rules + ([("is_valid", "all flag rules pass", "COUNT(*) FILTER (WHERE NOT is_valid)")] if with_valid else []):
        d = desc.replace("'", "''")
        rows.append(
            f"SELECT '{name}' AS rule, '{d}' AS description, CAST(COALESCE({failed}, 0) AS BIGINT) AS failed, "
            f"{r2(f'CAST({failed} AS DOUBLE) / NULLIF(COUNT(*), 0) * 100')} AS pct_failed, "
            f"CAST(COUNT(*) AS BIGINT) AS total_records FROM {source}"
        )
    return "\nUNION ALL\n".join(rows)


def _listing_report() -> str:
    desc = LISTING_RULE_TEXT
    failed = {
        "valid_price": "COUNT(*) FILTER (WHERE NOT flag_valid_price)",
        "valid_latitude": "COUNT(*) FILTER (WHERE NOT flag_valid_lat)",
        "valid_longitude": "COUNT(*) FILTER (WHERE NOT flag_valid_lon)",
        "valid_minimum_nights": "COUNT(*) FILTER (WHERE NOT flag_valid_min_nights)",
        "valid_availability": "COUNT(*) FILTER (WHERE NOT flag_valid_availability)",
        "valid_review_rating": "COUNT(*) FILTER (WHERE NOT flag_valid_rating)",
        "valid_listing_id": "COUNT(*) FILTER (WHERE NOT flag_valid_id)",
        "unique_listing_id": "(COUNT(*) - COUNT(DISTINCT id) - MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END))",
        "valid_host_since": "COUNT(*) FILTER (WHERE NOT flag_valid_host_since)",
    }
    return L(_report_sql("v_flagged", [(n, desc[n], failed[n]) for n in failed], True))


SQL["dq_listing_report"] = _listing_report()

SQL["dq_listing_summary"] = L(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_records, CAST(COUNT(*) FILTER (WHERE is_valid) AS BIGINT) AS total_valid,
  CAST(COUNT(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS total_invalid,
  {r2('CAST(COUNT(*) FILTER (WHERE is_valid) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100')} AS pct_valid
FROM v_flagged
""")

SQL["dq_calendar_report"] = C(_report_sql("v_calendar", [
    ("valid_price", CALENDAR_RULE_TEXT["valid_price"], "COUNT(*) FILTER (WHERE NOT flag_valid_price)"),
    ("valid_available", CALENDAR_RULE_TEXT["valid_available"], "COUNT(*) FILTER (WHERE NOT flag_valid_available)"),
], True))

SQL["valid_subset"] = L("SELECT id, price, latitude, longitude, is_valid FROM v_valid")

SQL["dedup_reviews"] = R("SELECT * FROM v_reviews")

SQL["dedup_landings"] = SQL["dedup_reviews"]

SQL["dedup_removed"] = R("SELECT CAST((SELECT COUNT(*) FROM v_reviews_raw) - (SELECT COUNT(*) FROM v_reviews) AS BIGINT) AS removed")

# ---------------------------------------------------------------- scalar functions

_RAW = f"WITH raw AS (SELECT {_select(domain.ATTR_RAW_LISTINGS)} FROM orders)\n"
_AMEN = f"WITH raw AS (SELECT {_select(domain.ATTR_RAW_AMENITIES)} FROM part)\n"
_DEC = r"'^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def _ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


SQL["parse_price"] = _RAW + f"""
SELECT id, price_text,
  CASE WHEN regexp_full_match(regexp_replace(price_text, '[$,\\s]', '', 'g'), {_DEC})
       THEN TRY_CAST(regexp_replace(price_text, '[$,\\s]', '', 'g') AS DOUBLE) END AS price
FROM raw
"""

SQL["parse_date"] = _RAW + f"""
SELECT id, date_text,
  CASE WHEN regexp_full_match({_ws('date_text')}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
       THEN TRY_CAST(try_strptime({_ws('date_text')}, '%Y-%m-%d') AS DATE) END AS parsed_date
FROM raw
"""

SQL["normalize_room_type"] = _RAW + f"SELECT id, room_type_text, {room_type_sql('room_type_text')} AS room_type FROM raw"

SQL["unknown_labels"] = _RAW + f"""
SELECT DISTINCT room_type_text FROM raw
WHERE room_type_text IS NOT NULL AND ({room_type_sql('room_type_text')}) IS NOT NULL
  AND lower(trim(room_type_text)) NOT IN ('entire home/apt', 'entire home', 'private room', 'shared room', 'hotel room')
ORDER BY room_type_text LIMIT 5
"""

SQL["normalize_property_type"] = f"""
SELECT property_type, {property_std_sql('property_type')} AS property_type_std, CAST(COUNT(*) AS BIGINT) AS listings
FROM (SELECT {domain.ATTR_LISTINGS['property_type']} AS property_type
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) p
GROUP BY 1, 2
"""

_ITEMS = f"""(CASE WHEN amenities_text IS NULL OR {_ws('amenities_text')} = '' THEN []::VARCHAR[]
  WHEN starts_with({_ws('amenities_text')}, '[') THEN
    CASE WHEN json_valid({_ws('amenities_text')}) THEN from_json({_ws('amenities_text')}, '["VARCHAR"]') ELSE []::VARCHAR[] END
  ELSE list_transform(
    list_filter(string_split(regexp_replace({_ws('amenities_text')}, '^[{{}}]+|[{{}}]+$', '', 'g'), ','), lambda x: {_ws('x')} <> ''),
    lambda x: regexp_replace({_ws('x')}, '^"+|"+$', '', 'g'))
  END)"""

SQL["parse_amenities"] = _AMEN + f"""
SELECT id, CAST(len(items) AS INTEGER) AS amenity_count, array_to_string(items, '|') AS items
FROM (SELECT id, {_ITEMS} AS items FROM raw) t
"""


def _flags_sql() -> str:
    cols = []
    for name, names in AMENITY_FLAGS.items():
        lits = ", ".join("'" + n.lower().replace("'", "''") + "'" for n in names)
        cols.append(f"COALESCE(list_has_any(list_filter(list_transform(items, lambda x: lower(x)), lambda x: x IS NOT NULL), [{lits}]), false) AS {name}")
    return _AMEN + f"SELECT id, {', '.join(cols)} FROM (SELECT id, {_ITEMS} AS items FROM raw) t"


SQL["amenity_flags"] = _flags_sql()

SQL["bool_decode"] = _RAW + """
SELECT id, bool_text,
  CASE WHEN bool_text IN ('t', 'True') THEN true WHEN bool_text IN ('f', 'False') THEN false END AS listing_bool,
  CASE WHEN bool_text = 't' THEN true WHEN bool_text = 'f' THEN false END AS calendar_bool
FROM raw
"""

SQL["safe_numeric"] = _RAW + f"""
SELECT id, number_text,
  CASE WHEN regexp_full_match({_ws('number_text')}, {_DEC}) THEN TRY_CAST({_ws('number_text')} AS DOUBLE) END AS value
FROM raw
"""

_TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
SQL["na_tokens"] = _RAW + f"SELECT id, CASE WHEN na_text IN ({_TOKENS}) THEN NULL ELSE na_text END AS value FROM raw"

SQL["comment_length"] = f"""
SELECT doc_id, c IS NULL AS is_missing, CAST(COALESCE(length(c), 0) AS INTEGER) AS comment_length FROM (
  SELECT doc_id, CASE WHEN text IS NULL OR {_ws('text')} IN ('nan', 'None') THEN NULL ELSE {_ws('text')} END AS c
  FROM documents
) d
"""

SQL["calendar_parts"] = C("SELECT listing_id, date, is_weekend, day_of_week, month, year FROM v_calendar")
SQL["host_tenure"] = L("SELECT id, host_since, host_tenure_years, days_since_last_review FROM v_listings")
SQL["price_per_bedroom"] = L("SELECT id, price, bedrooms, price_per_bedroom FROM v_listings")
SQL["commercial_host"] = L("SELECT id, calculated_host_listings_count, is_commercial_host FROM v_listings")
SQL["default_fill"] = L("""
SELECT id, COALESCE(bedrooms, 1.0) AS bedrooms, COALESCE(beds, 1.0) AS beds, COALESCE(bathrooms, 1.0) AS bathrooms,
  price_per_bedroom, COALESCE(accommodates, 2.0) AS accommodates, COALESCE(amenity_count, 0) AS amenity_count,
  COALESCE(has_ac, false) AS has_ac
FROM v_listings
""")

# ---------------------------------------------------------------- comparables
_REQ = f"SELECT {_select(domain.ATTR_REQUESTS)} FROM customer JOIN nation ON c_nationkey = n_nationkey"
_COMPS = f"""(
  SELECT * FROM (
    SELECT r.request_id, l.listing_id, l.listing_name, g.neighbourhood AS borough, l.room_type,
      COALESCE(l.bedrooms, 1) AS bedrooms, COALESCE(l.bathrooms, 1) AS bathrooms, l.accommodates, l.price,
      l.number_of_reviews, l.review_scores_rating, ABS(COALESCE(l.bedrooms, 1) - r.bedrooms) AS bedroom_distance,
      CAST(row_number() OVER (PARTITION BY r.request_id ORDER BY ABS(COALESCE(l.bedrooms, 1) - r.bedrooms) ASC,
                         l.number_of_reviews DESC NULLS LAST, l.listing_id ASC) AS INTEGER) AS comp_rank
    FROM ({_REQ}) r
    JOIN dim_geography g ON g.neighbourhood = r.borough
    JOIN dim_listings l ON l.listing_id = g.listing_id AND l.room_type = r.room_type
    WHERE ABS(COALESCE(l.bedrooms, 1) - r.bedrooms) <= 1 AND l.price BETWEEN 10 AND 2000
  ) t WHERE comp_rank <= 5
)"""

SQL["comparables"] = L(f"SELECT * FROM {_COMPS} c")
SQL["comparable_avg"] = L(f"""
SELECT request_id, CAST(COUNT(*) AS BIGINT) AS n_comparables, {r4('AVG(price)')} AS comparable_avg_price
FROM {_COMPS} c GROUP BY request_id
""")

# ---------------------------------------------------------------- statistics
_TEN = """(SELECT h.host_tenure_years AS x, l.price, l.review_scores_rating AS rating
  FROM dim_hosts h JOIN dim_listings l ON h.host_id = l.host_id
  WHERE h.host_tenure_years IS NOT NULL AND l.price < 2000 AND l.review_scores_rating IS NOT NULL)"""


def _ols_sql(y: str, x: str, src: str, label: str | None) -> str:
    tgt = f"'{label}' AS target, " if label else ""
    return f"""SELECT {tgt}CAST(regr_count({y}, {x}) AS BIGINT) AS n, {r4(f'regr_slope({y}, {x})')} AS slope,
  {r4(f'regr_intercept({y}, {x})')} AS intercept,
  {r4(f'CASE WHEN regr_sxx({y}, {x}) * regr_syy({y}, {x}) > 0 THEN regr_sxy({y}, {x}) / sqrt(regr_sxx({y}, {x}) * regr_syy({y}, {x})) END')} AS r,
  {r4(f'regr_r2({y}, {x})')} AS r2,
  {r4(f'sqrt(GREATEST(regr_syy({y}, {x}) - regr_slope({y}, {x}) * regr_sxy({y}, {x}), 0) / NULLIF(regr_count({y}, {x}) - 2, 0) / NULLIF(regr_sxx({y}, {x}), 0))')} AS stderr
FROM {src} t"""


SQL["ols_tenure"] = L(_ols_sql("price", "x", _TEN, "price") + "\nUNION ALL\n" + _ols_sql("rating", "x", _TEN, "rating"))

SQL["ols_cohort"] = L(f"""
SELECT CAST(regr_count(avg_price, x) AS BIGINT) AS n, {r4('regr_slope(avg_price, x)')} AS slope,
  {r4('regr_intercept(avg_price, x)')} AS intercept, {r4('regr_r2(avg_price, x)')} AS r2
FROM (
  SELECT h.host_tenure_years AS x, AVG(l.price) AS avg_price, AVG(l.review_scores_rating) AS avg_rating
  FROM dim_hosts h JOIN dim_listings l ON h.host_id = l.host_id
  WHERE h.host_tenure_years IS NOT NULL AND l.price < 2000
  GROUP BY h.host_tenure_years
) c WHERE avg_price IS NOT NULL AND avg_rating IS NOT NULL
""")

SQL["welch_ttest"] = L(f"""
SELECT n1, n2, {r4('mean1')} AS mean1, {r4('mean2')} AS mean2, {r4('var1')} AS var1, {r4('var2')} AS var2,
  {r4('(mean1 - mean2) / sqrt(var1 / n1 + var2 / n2)')} AS t_stat,
  {r4('(var1 / n1 + var2 / n2) * (var1 / n1 + var2 / n2) / ((var1 / n1) * (var1 / n1) / (n1 - 1) + (var2 / n2) * (var2 / n2) / (n2 - 1))')} AS dof
FROM (
  SELECT CAST(COUNT(*) FILTER (WHERE s) AS BIGINT) AS n1, CAST(COUNT(*) FILTER (WHERE NOT s) AS BIGINT) AS n2,
    AVG(price) FILTER (WHERE s) AS mean1, AVG(price) FILTER (WHERE NOT s) AS mean2,
    VAR_SAMP(price) FILTER (WHERE s) AS var1, VAR_SAMP(price) FILTER (WHERE NOT s) AS var2
  FROM (SELECT l.price, h.host_is_superhost AS s FROM dim_listings l JOIN dim_hosts h ON l.host_id = h.host_id
        WHERE l.price < 2000 AND h.host_is_superhost IS NOT NULL) d
) a
""")

# ---------------------------------------------------------------- model inputs
_FEAT = """(SELECT l.listing_id, l.price, l.room_type, g.neighbourhood,
    COALESCE(l.bedrooms, 1.0) AS bedrooms, COALESCE(l.bathrooms, 1.0) AS bathrooms,
    COALESCE(l.accommodates, 2.0) AS accommodates, COALESCE(l.beds, 1.0) AS beds,
    COALESCE(l.amenity_count, 0) AS amenity_count,
    """ + ",\n    ".join(f"CAST(COALESCE(l.{b}, false) AS INTEGER) AS {b}" for b in [
    "has_wifi", "has_kitchen", "has_parking", "has_ac", "has_washer", "has_tv", "has_elevator",
    "has_pool", "has_gym", "has_hot_tub", "has_breakfast", "is_pet_friendly", "has_self_checkin"]) + """
  FROM dim_listings l JOIN dim_geography g ON l.listing_id = g.listing_id
  WHERE l.price BETWEEN 10 AND 2000 AND l.room_type IS NOT NULL)"""

SQL["feature_table"] = L(f"SELECT * FROM {_FEAT} f")

SQL["label_encoding"] = L(f"""
SELECT 'room_type' AS category, value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT room_type AS value FROM {_FEAT} f) a
UNION ALL
SELECT 'borough' AS category, value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT neighbourhood AS value FROM {_FEAT} f) b
""")

SQL["train_test_split"] = L(f"""
SELECT listing_id,
  CASE WHEN CAST(('0x' || substr(md5(CAST(listing_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split
FROM {_FEAT} f
""")

SQL["revenue_grid"] = LC(f"""
SELECT borough, room_type, {r4('price')} AS price, {r4('occ')} AS occupancy_rate, default_pct,
  CAST(pct AS INTEGER) AS occupancy_pct, pct = default_pct AS is_default,
  {r4('30.0 * (pct / 100)')} AS booked_nights,
  {r4('price * (30.0 * (pct / 100))')} AS monthly_revenue,
  {r4('price * (30.0 * (pct / 100)) * 12')} AS annual_revenue
FROM (
  SELECT p.borough, p.room_type, p.price, COALESCE(o.occ, 0.45) AS occ,
    CAST(LEAST(GREATEST(CAST(round_even(COALESCE(o.occ, 0.45) * 100, 0) AS INTEGER), 30), 95) AS INTEGER) AS default_pct
  FROM (SELECT g.neighbourhood AS borough, l.room_type, AVG(l.price) AS price
        FROM dim_listings l JOIN dim_geography g ON l.listing_id = g.listing_id
        WHERE l.price BETWEEN 10 AND 2000 GROUP BY 1, 2) p
  LEFT JOIN (SELECT g.neighbourhood AS borough,
               CAST(COUNT(CASE WHEN NOT fc.available THEN 1 END) AS DOUBLE) / COUNT(*) AS occ
             FROM fact_calendar fc JOIN dim_geography g ON fc.listing_id = g.listing_id GROUP BY 1) o
    ON p.borough = o.borough
) b, range(30, 96) AS t(pct)
""")

# ---------------------------------------------------------------- landed files and ingestion
_BASE = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"

SQL["file_counts"] = f"""
SELECT 'listings' AS dataset, true AS non_empty, CAST(COUNT(*) AS BIGINT) AS row_count FROM {_BASE}
UNION ALL SELECT 'calendar', true, CAST(COUNT(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 'reviews', true, CAST(COUNT(*) AS BIGINT) FROM events
UNION ALL SELECT 'neighbourhoods', true, CAST(COUNT(DISTINCT n_name) AS BIGINT) FROM {_BASE}
"""

SQL["ingest_summary"] = f"""
SELECT 'london' AS city, 'bronze' AS layer, 'success' AS status, CAST(4 AS BIGINT) AS datasets, true AS one_event_per_file,
  CAST((SELECT COUNT(*) FROM {_BASE}) + (SELECT COUNT(*) FROM lineitem) + (SELECT COUNT(*) FROM events)
       + (SELECT COUNT(DISTINCT n_name) FROM {_BASE}) AS BIGINT) AS rows
UNION ALL
SELECT 'london', 'bronze', 'skipped', 4, true, CAST(NULL AS BIGINT)
"""

# landed ids are 18 digits long
SQL["silver_listings_csv"] = L("""
SELECT id + 549880000000000000 AS id, price, room_type, property_type_std, host_since, host_tenure_years, COALESCE(bedrooms, 1.0) AS bedrooms,
  COALESCE(beds, 1.0) AS beds, COALESCE(bathrooms, 1.0) AS bathrooms, price_per_bedroom, latitude, longitude,
  host_is_superhost, is_commercial_host, COALESCE(has_wifi, false) AS has_wifi, COALESCE(has_ac, false) AS has_ac,
  COALESCE(has_pool, false) AS has_pool, COALESCE(has_self_checkin, false) AS has_self_checkin, is_valid
FROM v_flagged
""")

SQL["silver_calendar_csv"] = C("SELECT listing_id + 549880000000000000 AS listing_id, date, available, price, is_weekend, month, year, is_valid FROM v_calendar")

SQL["neighbourhoods_clean"] = f"SELECT DISTINCT 'Region ' || CAST(n_regionkey AS VARCHAR) AS neighbourhood_group, n_name AS neighbourhood FROM {_BASE}"

SQL["display_table"] = L(f"""
SELECT request_id, comp_rank, listing_name AS "Listing Name", borough AS "Borough", room_type AS "Room Type",
  bedrooms AS "Beds", bathrooms AS "Baths", accommodates AS "Guests",
  CASE WHEN price IS NULL THEN NULL ELSE '£' || format('{{:,}}', CAST(round_even(price, 0) AS BIGINT)) END AS "Price/night",
  number_of_reviews AS "Reviews",
  COALESCE(printf('%.1f', review_scores_rating), 'N/A') AS "Rating"
FROM {_COMPS} c
""")

SQL["table_preview"] = C("SELECT * FROM fact_calendar ORDER BY listing_id, date, price NULLS FIRST LIMIT 1000")

# two bronze runs over the landed files: both runs finish successfully
SQL["run_state"] = f"""
SELECT 'london' AS city, 'bronze' AS phases, 'success' AS status, true AS finished, true AS ordered
FROM (SELECT COUNT(*) AS n FROM {_BASE}) t, range(2)
"""

# after a first run, only the dataset landed afterwards is pending
SQL["ingest_manifest"] = "SELECT 'reviews_update' AS dataset, COUNT(*) > 0 AS non_empty FROM events"

SQL["silver_calendar_stream"] = SQL["silver_calendar_csv"]


def _top_values_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM dim_listings WHERE {c} IS NOT NULL"
             for c, _ in _DIM_LISTINGS]
    return L(f"""
SELECT column_name, value, count, rank FROM (
  SELECT column_name, value, CAST(COUNT(*) AS BIGINT) AS count,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY COUNT(*) DESC, value ASC) AS INTEGER) AS rank
  FROM ({' UNION ALL '.join(parts)}) s
  GROUP BY column_name, value
) t WHERE rank <= 5
""")


SQL["profile_top_values"] = _top_values_sql()

SQL["silver_reviews_csv"] = R(f"""
SELECT listing_id, id, date, reviewer_id, comments, CAST(COALESCE(length(comments), 0) AS INTEGER) AS comment_length FROM (
  SELECT listing_id + 549880000000000000 AS listing_id, id + 549880000000000000 AS id, date, reviewer_id,
    CASE WHEN c IS NULL OR {_ws('c')} IN ('nan', 'None') THEN NULL ELSE {_ws('c')} END AS comments,
    row_number() OVER (PARTITION BY listing_id, reviewer_id, date ORDER BY id NULLS LAST) AS rn
  FROM (SELECT *, CASE WHEN id % 29 = 0 THEN comments || chr(10) || 'second line, with "quotes"' ELSE comments END AS c FROM v_reviews_raw) r
) t WHERE rn = 1
""")

SQL["split_csv"] = SQL["silver_reviews_csv"]

SQL["reordered_csv"] = C("SELECT listing_id, date, price FROM v_calendar")

SQL["union_by_name"] = C("SELECT listing_id, date, price, CASE WHEN listing_id % 3 = 2 THEN NULL ELSE available END AS available FROM v_calendar")

SQL["silver_listings_write"] = L("""
SELECT 'full' AS written, room_type, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(id) AS BIGINT) AS id_sum FROM v_flagged GROUP BY room_type
UNION ALL
SELECT 'clean', room_type, CAST(COUNT(*) AS BIGINT), CAST(SUM(id) AS BIGINT) FROM v_valid GROUP BY room_type
""")

SQL["resolved_source"] = C("""
SELECT 'preferred' AS rule, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(listing_id + 3) AS BIGINT) AS id_sum FROM v_calendar
UNION ALL
SELECT 'first', CAST(COUNT(*) AS BIGINT), CAST(SUM(listing_id + 1) AS BIGINT) FROM v_calendar
""")

SQL["latest_event"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) t WHERE rn = 1
"""

# ---------------------------------------------------------------- p-values by Simpson's rule


def _p_sql(t: str, v: str) -> str:
    """Two-sided tail of the t density: with t = sqrt(v) tan(a) it is proportional to cos(a)^(v - 1)."""
    start, end = f"atan(abs({t}) / sqrt({v}))", f"LEAST(pi() / 2, atan(abs({t}) / sqrt({v})) + 14 / sqrt({v}))"
    f = f"(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(({v} - 1) * ln(GREATEST(cos({start} + i * ({end} - {start}) / 4000), 1e-300)))"
    return (f"(SELECT 2 * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt(pi()) * ({end} - {start}) / 12000 * SUM({f}) "
            "FROM range(4001) AS s(i))")


def _significance_sql(t: str, v: str, columns: str, src: str) -> str:
    return f"SELECT {columns}, {r4('p')} AS p_value, p < 0.05 AS significant FROM (SELECT *, {_p_sql(t, v)} AS p FROM {src}) q"


_FITS = "\nUNION ALL\n".join(f"""SELECT '{label}' AS target, CAST(regr_count({y}, x) AS BIGINT) AS n, regr_slope({y}, x) AS slope,
  regr_slope({y}, x) / sqrt(GREATEST(regr_syy({y}, x) - regr_slope({y}, x) * regr_sxy({y}, x), 0) / (regr_count({y}, x) - 2) / regr_sxx({y}, x)) AS t_stat,
  CAST(regr_count({y}, x) - 2 AS DOUBLE) AS dof
FROM {_TEN} t""" for label, y in (("price", "price"), ("rating", "rating")))
SQL["ols_significance"] = L(_significance_sql("t_stat", "dof", f"target, n, {r4('slope')} AS slope, {r4('t_stat')} AS t_stat", f"({_FITS}) f"))

SQL["welch_pvalue"] = L(_significance_sql("t_stat", "dof", f"n1, n2, {r4('t_stat')} AS t_stat, {r4('dof')} AS dof", """(
  SELECT n1, n2, (mean1 - mean2) / sqrt(var1 / n1 + var2 / n2) AS t_stat,
    (var1 / n1 + var2 / n2) * (var1 / n1 + var2 / n2) / ((var1 / n1) * (var1 / n1) / (n1 - 1) + (var2 / n2) * (var2 / n2) / (n2 - 1)) AS dof
  FROM (
    SELECT CAST(COUNT(*) FILTER (WHERE s) AS BIGINT) AS n1, CAST(COUNT(*) FILTER (WHERE NOT s) AS BIGINT) AS n2,
      AVG(price) FILTER (WHERE s) AS mean1, AVG(price) FILTER (WHERE NOT s) AS mean2,
      VAR_SAMP(price) FILTER (WHERE s) AS var1, VAR_SAMP(price) FILTER (WHERE NOT s) AS var2
    FROM (SELECT l.price, h.host_is_superhost AS s FROM dim_listings l JOIN dim_hosts h ON l.host_id = h.host_id
          WHERE l.price < 2000 AND h.host_is_superhost IS NOT NULL) d
  ) a
) w"""))

# ---------------------------------------------------------------- model arithmetic on group means
_SPLIT = f"""(SELECT *, CAST(('0x' || substr(md5(CAST(listing_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 AS held FROM {_FEAT} f0)"""
_MEANS = f"(SELECT neighbourhood, room_type, AVG(price) AS m FROM {_SPLIT} s WHERE NOT held GROUP BY 1, 2)"
_OVERALL = f"(SELECT AVG(price) FROM {_SPLIT} s WHERE NOT held)"
_METRICS = f"""(SELECT CAST(COUNT(*) AS BIGINT) AS n_test, sqrt(AVG((p - price) * (p - price))) AS rmse, AVG(abs(p - price)) AS mae,
    1 - SUM((p - price) * (p - price)) / (VAR_POP(price) * COUNT(*)) AS r2
  FROM (SELECT t.price, COALESCE(m.m, {_OVERALL}) AS p FROM {_SPLIT} t
        LEFT JOIN {_MEANS} m ON t.neighbourhood = m.neighbourhood AND t.room_type = m.room_type WHERE t.held) e)"""
SQL["mean_predictor_metrics"] = L(f"SELECT n_test, {r4('rmse')} AS rmse, {r4('mae')} AS mae, {r4('r2')} AS r2 FROM {_METRICS} q")

SQL["mean_predictor_band"] = L(f"""
SELECT request_id, borough, room_type, {r4('p')} AS predicted_price, {r4('GREATEST(10.0, p - mae)')} AS price_low, {r4('p + mae')} AS price_high,
  abs(p - avg_price) < mae AS within_mae
FROM (
  SELECT r.request_id, r.borough, r.room_type, COALESCE(m.m, {_OVERALL}) AS p, (SELECT mae FROM {_METRICS} q) AS mae, c.avg_price
  FROM ({_REQ}) r
  LEFT JOIN {_MEANS} m ON r.borough = m.neighbourhood AND r.room_type = m.room_type
  LEFT JOIN (SELECT request_id, AVG(price) AS avg_price FROM {_COMPS} c0 GROUP BY request_id) c ON r.request_id = c.request_id
) b
""")

SQL["mean_predictor_boroughs"] = LC(f"""
SELECT request_id, borough, {r4('p')} AS predicted_price, {r4('occ')} AS occupancy, {r4('p * 30 * occ')} AS monthly_revenue, selected,
  CAST(row_number() OVER (PARTITION BY request_id ORDER BY p * 30 * occ DESC, borough) AS INTEGER) AS rank
FROM (
  SELECT r.request_id, b.borough, COALESCE(m.m, {_OVERALL}) AS p, COALESCE(o.occ, s.occ, 0.45) AS occ, b.borough = r.borough AS selected
  FROM ({_REQ}) r CROSS JOIN (SELECT DISTINCT neighbourhood AS borough FROM {_MEANS} x) b
  LEFT JOIN {_MEANS} m ON b.borough = m.neighbourhood AND r.room_type = m.room_type
  LEFT JOIN (SELECT g.neighbourhood AS borough, CAST(COUNT(CASE WHEN NOT fc.available THEN 1 END) AS DOUBLE) / COUNT(*) AS occ
             FROM fact_calendar fc JOIN dim_geography g ON fc.listing_id = g.listing_id WHERE length(g.neighbourhood) % 3 <> 0 GROUP BY 1) o ON b.borough = o.borough
  LEFT JOIN (SELECT g.neighbourhood AS borough, CAST(COUNT(CASE WHEN NOT fc.available THEN 1 END) AS DOUBLE) / COUNT(*) AS occ
             FROM fact_calendar fc JOIN dim_geography g ON fc.listing_id = g.listing_id WHERE length(g.neighbourhood) % 3 <> 0 GROUP BY 1) s ON r.borough = s.borough
) t
""")

# the request's features, weighted 1, 2, 3 ... in this order
_REQUEST_FEATURES = ["bedrooms", "bathrooms", "accommodates", "beds", "amenity_count", "has_wifi", "has_kitchen", "has_parking", "has_ac", "has_washer",
                     "has_tv", "has_elevator", "has_pool", "has_gym", "has_hot_tub", "has_breakfast", "is_pet_friendly", "has_self_checkin"]
_IMPACTS = "\nUNION ALL\n".join(
    f"SELECT request_id, '{c}' AS feature, {r4(f'(CAST({c} AS DOUBLE) - (SELECT AVG(CAST({c} AS DOUBLE)) FROM ({_REQ}) a)) * {i + 1}')} AS impact FROM ({_REQ}) r"
    for i, c in enumerate(_REQUEST_FEATURES))
SQL["top_impacts"] = f"""
SELECT request_id, feature, impact, rank, CASE WHEN impact >= 0 THEN 'up' ELSE 'down' END AS direction FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY abs(impact) DESC, feature) AS INTEGER) AS rank FROM ({_IMPACTS}) i
) t WHERE rank <= 12
"""

SQL["manifest_check"] = f"""
SELECT 'listings' AS dataset, COUNT(*) > 0 AS is_ok, COUNT(*) > 0 AS has_bytes FROM {_BASE}
UNION ALL SELECT 'calendar', COUNT(*) > 0, COUNT(*) > 0 FROM lineitem
UNION ALL SELECT 'reviews', COUNT(*) > 0, COUNT(*) > 0 FROM events
UNION ALL SELECT 'neighbourhoods', COUNT(*) > 0, COUNT(*) > 0 FROM {_BASE}
UNION ALL SELECT 'prices', false, false
"""

_LANDED_ROWS = f"""SELECT 'listings' AS dataset, CAST(COUNT(*) AS BIGINT) AS rows FROM {_BASE}
UNION ALL SELECT 'calendar', CAST(COUNT(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 'reviews', CAST(COUNT(*) AS BIGINT) FROM events
UNION ALL SELECT 'neighbourhoods', CAST(COUNT(DISTINCT n_name) AS BIGINT) FROM {_BASE}"""
SQL["ingest_history"] = f"""
SELECT 'bronze' AS layer, dataset, 'success' AS status, rows, true AS sized FROM ({_LANDED_ROWS}) a
UNION ALL SELECT 'bronze', dataset, 'skipped', CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN) FROM ({_LANDED_ROWS}) b
"""

SQL["mix_display"] = L("""
SELECT room_type, printf('%.1f%%', round(c * 100.0 / SUM(c) OVER (), 9)) AS share, format('{:,}', c) AS listings
FROM (SELECT room_type, CAST(COUNT(*) AS BIGINT) AS c FROM dim_listings GROUP BY room_type) m
""")

SQL["snapshot_rewrite"] = R("""
SELECT t.reader, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(review_id) AS BIGINT) AS id_sum
FROM fact_reviews, (SELECT unnest(['held', 'newest', 'first']) AS reader) t
WHERE t.reader <> 'newest' OR comment_length > 0 GROUP BY t.reader
""")

SQL["silver_run"] = LCR("""
SELECT 'listings_full.parquet' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS BIGINT) AS logged FROM v_flagged
UNION ALL SELECT 'listings.parquet', CAST(COUNT(*) AS BIGINT), 'success', CAST(COUNT(*) AS BIGINT) FROM v_valid
UNION ALL SELECT 'calendar.parquet', CAST(COUNT(*) AS BIGINT), 'success', CAST(COUNT(*) AS BIGINT) FROM v_calendar
UNION ALL SELECT 'reviews.parquet', CAST(COUNT(*) AS BIGINT), 'success', CAST(COUNT(*) AS BIGINT) FROM v_reviews
UNION ALL SELECT 'neighbourhoods.parquet', CAST(COUNT(*) AS BIGINT), 'success', CAST(COUNT(*) AS BIGINT)
  FROM (SELECT DISTINCT n_regionkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) n
""")

SQL["pipeline_run"] = LCR("""
SELECT m.mart, CAST(m.n AS BIGINT) AS rows, 'bronze,silver,gold' AS phases, 'success' AS status FROM (
  SELECT 'dim_listings' AS mart, COUNT(*) AS n FROM dim_listings
  UNION ALL SELECT 'dim_hosts', COUNT(*) FROM dim_hosts
  UNION ALL SELECT 'dim_geography', COUNT(*) FROM dim_geography
  UNION ALL SELECT 'fact_calendar', COUNT(*) FROM fact_calendar
  UNION ALL SELECT 'fact_reviews', COUNT(*) FROM fact_reviews) m
""")

SQL["model_registry"] = L(f"""
SELECT 500 AS trees, 6 AS depth, 20 AS features, CAST(COUNT(DISTINCT f.room_type) AS INTEGER) AS room_types,
  CAST(COUNT(DISTINCT f.neighbourhood) AS INTEGER) AS boroughs,
  CAST(COUNT(*) FILTER (WHERE CAST(('0x' || substr(md5(CAST(listing_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20) AS BIGINT) AS test_rows,
  true AS rmse_at_least_mae
FROM {_FEAT} f
""")

_STEP_REVIEWS = "SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT DISTINCT listing_id, reviewer_id, date FROM v_reviews_typed WHERE {}) k"

SQL["resumed_runs"] = R(f"""
SELECT run, phase, status, CASE WHEN run LIKE '1%' THEN NULL WHEN run LIKE '4%' THEN ({_STEP_REVIEWS.format('true')})
  ELSE ({_STEP_REVIEWS.format('id % 2 = 0')}) END AS review_rows
FROM (VALUES ('1 without calendar', 'silver', 'partial'), ('1 without calendar', 'gold', 'failed'),
  ('2 complete', 'silver', 'success'), ('2 complete', 'gold', 'success'), ('3 nothing new', 'silver', 'skipped'), ('3 nothing new', 'gold', 'skipped'),
  ('4 more reviews', 'silver', 'success'), ('4 more reviews', 'gold', 'success')) t(run, phase, status)
""")

SQL["unique_landings"] = L("""
SELECT i AS landing, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT id) AS BIGINT) AS distinct_ids, CAST(COUNT(*) - COUNT(DISTINCT id) AS BIGINT) AS failed
FROM (SELECT unnest(range(0, 3)) AS i) n JOIN (
  SELECT id, id % 3 AS landed FROM v_listings UNION ALL SELECT id, id % 10 FROM v_listings WHERE id % 10 < 3
) s ON s.landed <= n.i GROUP BY i
""")

SQL["cohort_trend"] = L(f"""
WITH_COHORTS
SELECT host_tenure_years, {r4('avg_price')} AS avg_price, {r4('i + k * host_tenure_years')} AS fitted
FROM c, (SELECT regr_intercept(avg_price, host_tenure_years) AS i, regr_slope(avg_price, host_tenure_years) AS k FROM c) f
""").replace("\nWITH_COHORTS", """, c AS (
  SELECT h.host_tenure_years, AVG(l.price) AS avg_price, AVG(l.review_scores_rating) AS avg_rating
  FROM dim_hosts h JOIN dim_listings l ON h.host_id = l.host_id
  WHERE h.host_tenure_years IS NOT NULL AND l.price < 2000
  GROUP BY h.host_tenure_years HAVING AVG(l.price) IS NOT NULL AND AVG(l.review_scores_rating) IS NOT NULL
)""")

SQL["landed_sizes"] = LCR("""
SELECT 'calendar' AS dataset, true AS is_ok, CAST(SUM(length(CAST(listing_id AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM v_calendar
UNION ALL SELECT 'reviews', true, CAST(SUM(length(CAST(id AS VARCHAR)) + 1) AS BIGINT) FROM v_reviews_raw
UNION ALL SELECT 'prices', false, 0 UNION ALL SELECT 'hosts', false, 0
""")

SQL["table_listing"] = LC("""
SELECT m.mart, 'EXTERNAL' AS table_type, false AS is_temporary, CAST(m.n AS BIGINT) AS rows FROM (
  SELECT 'dim_listings' AS mart, COUNT(*) AS n FROM dim_listings
  UNION ALL SELECT 'dim_hosts', COUNT(*) FROM dim_hosts
  UNION ALL SELECT 'dim_geography', COUNT(*) FROM dim_geography
  UNION ALL SELECT 'calendar_state', COUNT(*) FROM (SELECT DISTINCT listing_id, year, month FROM v_calendar WHERE listing_id IS NOT NULL) k) m
""")
