"""Fixed values.

These are lookup values whose content must match the source system's cleaning
rules exactly for results to agree; they are stated here plainly, in the order
the source lists them, and are used as data by the expression builders.
"""

from __future__ import annotations

# --- Fixed values: tokens that a pandas CSV reader turns into missing values ---
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# --- Fixed values: room type labels (lower-cased, trimmed key -> label) ---
ROOM_TYPE_LABELS = {
    "entire home/apt": "Entire home/apt",
    "entire home": "Entire home/apt",
    "private room": "Private room",
    "shared room": "Shared room",
    "hotel room": "Hotel room",
}

# --- Fixed values: property type groups (lower-cased, trimmed key -> group) ---
PROPERTY_TYPE_GROUPS = {
    "entire apartment": "Apartment",
    "private room in apartment": "Apartment",
    "shared room in apartment": "Apartment",
    "entire condominium": "Apartment",
    "entire residential home": "House",
    "entire house": "House",
    "private room in house": "House",
    "shared room in house": "House",
    "entire townhouse": "Townhouse",
    "entire loft": "Loft",
    "private room in loft": "Loft",
    "entire serviced apartment": "Serviced Apartment",
    "entire guest suite": "Guest Suite",
    "private room in guest suite": "Guest Suite",
    "room in boutique hotel": "Hotel",
    "entire hotel": "Hotel",
    "private room in hostel": "Hostel",
    "shared room in hostel": "Hostel",
    "entire villa": "Villa",
    "entire cottage": "Cottage",
    "entire bungalow": "Bungalow",
    "boat": "Unique",
    "treehouse": "Unique",
    "camper/rv": "Unique",
    "tent": "Unique",
}
PROPERTY_TYPE_OTHER = "Other"

# --- Fixed values: amenity flags and the amenity names that set each flag ---
AMENITY_FLAGS = {
    "has_wifi": ["Wifi", "Wireless Internet"],
    "has_kitchen": ["Kitchen"],
    "has_parking": ["Free parking on premises", "Paid parking on premises", "Parking"],
    "has_ac": ["Air conditioning"],
    "has_washer": ["Washer"],
    "has_tv": ["TV", "Cable TV"],
    "has_elevator": ["Elevator"],
    "has_pool": ["Pool"],
    "has_gym": ["Gym"],
    "has_hot_tub": ["Hot tub"],
    "has_breakfast": ["Breakfast"],
    "is_pet_friendly": ["Pets allowed"],
    "has_long_term_stays": ["Long term stays allowed"],
    "has_self_checkin": ["Self check-in", "Keypad", "Lockbox", "Smart lock"],
}

# --- Fixed values: boolean text codes ---
LISTING_TRUE = ["t", "True"]
LISTING_FALSE = ["f", "False"]
CALENDAR_TRUE = ["t"]
CALENDAR_FALSE = ["f"]

# --- Fixed values: superhost display labels ---
SUPERHOST_LABELS = ("Superhost", "Regular Host", "Unknown")

# --- Fixed values: data-quality limits and defaults ---
MIN_NIGHTS_RANGE = (1, 1125)
AVAILABILITY_RANGE = (0, 365)
RATING_RANGE = (0, 5)
DEFAULT_OCCUPANCY = 0.45
OCCUPANCY_PCT_RANGE = (30, 95)
NIGHTS_PER_MONTH = 30
PRICE_FLOOR = 10
TRAIN_PRICE_RANGE = (10, 2000)
DAYS_PER_YEAR = 365.25

# --- Fixed values: data-quality rule names and report descriptions ---
LISTING_RULE_TEXT = {
    "valid_price": "price > 0",
    "valid_latitude": "lat ∈ [{lat_min}, {lat_max}]",
    "valid_longitude": "lon ∈ [{lon_min}, {lon_max}]",
    "valid_minimum_nights": "minimum_nights ∈ [1, 1125]",
    "valid_availability": "availability_365 ∈ [0, 365]",
    "valid_review_rating": "review_scores_rating ∈ [0, 5] (when not null)",
    "valid_listing_id": "listing id is not null",
    "unique_listing_id": "listing id is unique",
    "valid_host_since": "host_since <= today",
}
CALENDAR_RULE_TEXT = {
    "valid_price": "price > 0 (when not null)",
    "valid_available": "available is boolean",
}

# --- Fixed values: landed file names per dataset (preferred names in order, then a
# name fragment and suffix that any fallback file must have) ---
LANDED_FILES = {
    "listings": (["listings_detailed_listings.csv.gz", "listings_listings.csv.gz"], "listings", ".gz"),
    "calendar": (["calendar_calendar.csv.gz"], "calendar", ".gz"),
    "reviews": (["reviews_reviews.csv.gz"], "reviews", ".gz"),
    "neighbourhoods": (["neighbourhoods_csv_neighbourhoods.csv"], "neighbourhood", ".csv"),
}
