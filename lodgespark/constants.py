"""Fixed values that must equal the original pipeline's for equal results.

All values here are stated as plain text, in natural order, in one place.
"""

# --- fixed values: price categories (label order: unknown, then ascending) ---
CATEGORY_UNKNOWN = "No especificado"
CATEGORY_LOW = "Económico"
CATEGORY_MID = "Medio"
CATEGORY_HIGH = "Alto"
CATEGORY_TOP = "Lujo"
CATEGORY_LABELS = [CATEGORY_UNKNOWN, CATEGORY_LOW, CATEGORY_MID, CATEGORY_HIGH, CATEGORY_TOP]

# --- fixed values: quartile fallbacks used when a quartile is exactly 0 ---
DEFAULT_Q25 = 60000.0
DEFAULT_Q50 = 120000.0
DEFAULT_Q75 = 250000.0

# --- fixed values: default comment for a missing review text ---
MISSING_COMMENT = "Sin comentario"

# --- fixed values: serving-zone text cut and display cut ---
COMMENT_MAX_CHARS = 4000
DISPLAY_MAX_CHARS = 70

# --- fixed values: missing-value tokens of the raw CSV reader ---
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# --- fixed values: columns dropped from listings as sparse ---
KNOWN_SPARSE_COLUMNS = ["neighbourhood_group_cleansed", "license", "calendar_updated"]

# --- fixed values: listing date columns parsed to dates ---
LISTING_DATE_COLUMNS = ["host_since", "first_review", "last_review", "calendar_last_scraped", "last_scraped"]

# --- fixed values: listing 't'/'f' flag columns ---
LISTING_FLAG_COLUMNS = [
    "host_is_superhost", "host_has_profile_pic", "host_identity_verified",
    "has_availability", "instant_bookable",
]

# --- fixed values: numeric listing columns and their null defaults (None = keep null) ---
LISTING_NUMERIC_DEFAULTS = {
    "accommodates": 1,
    "bedrooms": 1,
    "beds": 1,
    "bathrooms": 1,
    "minimum_nights": 1,
    "maximum_nights": 365,
    "availability_365": 0,
    "number_of_reviews": 0,
    "review_scores_rating": None,
}

# --- fixed values: numeric columns described in the analysis ---
DESCRIBE_COLUMNS = [
    "accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights", "maximum_nights",
    "availability_30", "availability_365", "number_of_reviews", "reviews_per_month",
    "review_scores_rating",
]

# --- fixed values: variables of the outlier analysis ---
OUTLIER_COLUMNS = [
    "price_num", "minimum_nights", "availability_365", "number_of_reviews",
    "review_scores_rating", "accommodates",
]

# --- fixed values: columns of the correlation matrix ---
CORRELATION_COLUMNS = [
    "price_num", "accommodates", "bedrooms", "beds", "minimum_nights", "availability_365",
    "number_of_reviews", "review_scores_rating", "reviews_per_month", "n_amenities",
]

# --- fixed values: date and price columns sampled by the format check ---
FORMAT_SAMPLE_DATE_COLUMNS = [
    "last_scraped", "host_since", "first_review", "last_review", "calendar_last_scraped",
    "price_quote_checkin_date", "price_quote_checkout_date",
]

# --- fixed values: serving projection of listings (source column -> serving column) ---
SERVING_LISTINGS = {
    "id": "id",
    "name": "name",
    "host_id": "host_id",
    "host_name": "host_name",
    "host_since": "host_since",
    "host_is_superhost": "host_is_superhost",
    "neighbourhood_cleansed": "neighbourhood_cleansed",
    "latitude": "latitude",
    "longitude": "longitude",
    "property_type": "property_type",
    "room_type": "room_type",
    "accommodates": "accommodates",
    "bathrooms": "bathrooms",
    "bedrooms": "bedrooms",
    "beds": "beds",
    "price_clean": "price",
    "price_category": "price_category",
    "minimum_nights": "minimum_nights",
    "maximum_nights": "maximum_nights",
    "availability_365": "availability_365",
    "number_of_reviews": "number_of_reviews",
    "review_scores_rating": "review_scores_rating",
    "n_amenities": "n_amenities",
    "host_since_year": "host_since_year",
}

# --- fixed values: serving projection of reviews ---
SERVING_REVIEWS = [
    "id", "listing_id", "date", "reviewer_id", "reviewer_name", "comments",
    "year", "month", "day", "quarter", "is_weekend",
]

# --- fixed values: serving projection of calendar ---
SERVING_CALENDAR = [
    "listing_id", "date", "is_available", "minimum_nights", "maximum_nights",
    "year", "month", "week", "quarter", "day_of_week",
]

# --- fixed values: export projection of listings ---
EXPORT_LISTINGS = [
    "id", "name", "host_id", "host_name", "host_since", "host_is_superhost",
    "neighbourhood_cleansed", "room_type", "accommodates", "bedrooms",
    "price_clean", "price_category", "minimum_nights", "availability_365",
    "number_of_reviews", "review_scores_rating", "n_amenities",
]

# --- fixed values: reviews extract of the report bundle ---
EXPORT_REVIEWS = ["id", "listing_id", "date", "reviewer_name", "year", "month", "quarter", "is_weekend"]

#: One lookup per access path of a table: its name, and the condition (SQL that both engines read).
ACCESS_PROBES = {
    "listings": [("id", "id = '7'"), ("host_id", "host_id = '42'"), ("neighbourhood_cleansed", "neighbourhood_cleansed = 'Brand#13'"),
                 ("room_type", "room_type LIKE 'SMALL%'"),
                 ("latitude,longitude", "latitude >= '40.2' AND latitude < '40.6' AND longitude >= '-3.1' AND longitude < '-3.5'")],
    "reviews": [("listing_id", "listing_id = 7"), ("id", "id IN ('10', '12', '71')"), ("date", "date = DATE '1996-03-13'"),
                ("listing_id,date", "listing_id BETWEEN 5 AND 9 AND date >= DATE '1996-01-01'")],
    "calendar": [("listing_id", "listing_id = 7"), ("date", "date = DATE '1996-03-13'"),
                 ("listing_id,date", "listing_id BETWEEN 5 AND 9 AND date >= DATE '1996-01-01'")],
}
