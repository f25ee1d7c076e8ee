"""Independent DuckDB SQL for every registered query (the correctness gate).

Written from the semantics, not generated from the Spark plans: the shared
CTEs rebuild the raw views, the keep-first deduplication and the cleaning
transforms in plain SQL.  Views ``part``, ``lineitem``, ``documents`` ... are
registered by the checker.
"""

from __future__ import annotations

from lodgespark.constants import ACCESS_PROBES

HS = "strftime(DATE '2010-01-01' + CAST(p_partkey % 5000 AS INTEGER), '%Y-%m-%d')"
PRICE = "format('{:,.2f}', p_retailprice * (1 + p_partkey % 37))"
SHIP = "strftime(l_shipdate, '%Y-%m-%d')"
NUM_RE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
ISO_TIME_RE = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
ISO_RE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def num(c: str) -> str:
    return f"(CASE WHEN regexp_matches(CAST({c} AS VARCHAR), '{NUM_RE}') THEN try_cast(trim(CAST({c} AS VARCHAR)) AS DOUBLE) END)"


def pdate(c: str) -> str:
    return (f"(CASE WHEN regexp_matches({c}, '{ISO_RE}') THEN try_cast({c} AS DATE) "
            f"WHEN regexp_matches({c}, '{ISO_TIME_RE}') THEN CAST(try_cast({c} AS TIMESTAMP) AS DATE) END)")


# the Python literals of the fixture are the lists that are not JSON; their items are written out by hand
ITEMS = ("(CASE WHEN amenities = '[''x'', (''y'',''z'')]' THEN ['x', '(''y'',''z'')'] "
         "WHEN starts_with(amenities, '[''x'', [''y''') THEN ['x', '[''y'', (''z'', {''k'': [1, 2]})]', '{''a''}'] "
         "WHEN starts_with(amenities, '[''caf') THEN ['café', 'A''s', '[None]'] "
         "ELSE coalesce(from_json(try_cast(amenities AS JSON), '[\"VARCHAR\"]'), []::VARCHAR[]) END)")
N_ITEMS = f"len({ITEMS})"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def flag(c: str) -> str:
    return f"(CASE {c} WHEN 't' THEN TRUE WHEN 'f' THEN FALSE END)"


CTES = {
    "listings_base": f"""
SELECT CASE WHEN p_partkey % 157 = 0 THEN concat('L-', CAST(p_partkey AS VARCHAR)) ELSE CAST(p_partkey AS VARCHAR) END AS id, p_name AS name, CAST(p_partkey % 100 AS VARCHAR) AS host_id,
  concat('host ', CAST(p_partkey % 100 AS VARCHAR)) AS host_name,
  CASE WHEN p_partkey % 89 = 0 THEN 'bad-date' WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN '2020-01-01 junk' ELSE {HS} END AS host_since,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE {HS} END AS last_review,
  CASE p_partkey % 5 WHEN 0 THEN 't' WHEN 4 THEN NULL ELSE 'f' END AS host_is_superhost,
  CASE p_partkey % 6 WHEN 0 THEN 'f' WHEN 5 THEN 'yes' ELSE 't' END AS instant_bookable,
  CASE WHEN p_partkey % 200 = 1 THEN NULL ELSE p_brand END AS neighbourhood_cleansed,
  CAST(NULL AS VARCHAR) AS neighbourhood_group_cleansed,
  CASE WHEN p_partkey % 50 = 0 THEN 'L-1' END AS license,
  CASE WHEN p_partkey % 150 = 2 THEN NULL ELSE p_type END AS room_type,
  CAST(p_size % 16 + 1 AS VARCHAR) AS accommodates,
  CASE WHEN p_partkey % 83 = 0 THEN 'x' WHEN p_partkey % 71 = 0 THEN '1.5' WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size % 6 AS VARCHAR) END AS bedrooms,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size % 4 + 1 AS VARCHAR) END AS beds,
  CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN '1.5' ELSE '1' END AS bathrooms,
  CASE WHEN p_partkey % 250 = 3 THEN '1000' ELSE CAST(p_size % 30 + 1 AS VARCHAR) END AS minimum_nights,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE '365' END AS maximum_nights,
  CAST(p_partkey * 37 % 366 AS VARCHAR) AS availability_365,
  CAST(p_partkey * 13 % 41 AS VARCHAR) AS number_of_reviews,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size % 5 + 1 AS VARCHAR) END AS review_scores_rating,
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 101 = 0 THEN '$0.00'
       WHEN p_partkey % 61 = 0 THEN concat('$', format('{{:,.2f}}', p_retailprice * (1 + p_partkey % 37) * 500))
       ELSE concat('$', {PRICE}) END AS price,
  CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 59 = 0 THEN 'not json' WHEN p_partkey % 11 = 0 THEN '[]'
       WHEN p_partkey % 67 = 0 THEN '["a","b"] junk' WHEN p_partkey % 73 = 0 THEN '[''x'', (''y'',''z'')]'
       WHEN p_partkey % 79 = 0 THEN '["a",["b",["c",{{"k":[1,2]}}]],null]'
       WHEN p_partkey % 103 = 0 THEN '[''x'', [''y'', (''z'', {{''k'': [1, 2]}})], {{''a''}}]'
       WHEN p_partkey % 107 = 0 THEN '[''caf\\u00e9'', ''\\x41\\''s'', [None]]' WHEN p_partkey % 109 = 0 THEN '["a",["b"]] ]'
       ELSE concat('["', replace(p_name, ' ', '","'), '"]') END AS amenities,
  CASE WHEN p_partkey % 13 = 0 THEN 'N/A' ELSE concat(CAST(p_partkey % 101 AS VARCHAR), '%') END AS host_response_rate,
  CASE WHEN p_partkey % 14 = 0 THEN 'N/A' ELSE concat(CAST(p_partkey % 100 AS VARCHAR), '%') END AS host_acceptance_rate,
  concat('40.', lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')) AS latitude,
  concat('-3.', lpad(CAST(p_partkey % 997 AS VARCHAR), 3, '0')) AS longitude,
  concat('type ', CAST(p_partkey % 12 AS VARCHAR)) AS property_type,
  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 47 = 0 THEN 'unknown' ELSE {HS} END AS first_review,
  CASE WHEN p_partkey % 29 <> 0 THEN '2024-06-15' END AS last_scraped,
  CASE WHEN p_partkey % 41 = 0 THEN '2024-06-16T10:00:00' ELSE '2024-06-16' END AS calendar_last_scraped,
  CAST(NULL AS VARCHAR) AS calendar_updated,
  CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 'f' ELSE 't' END AS has_availability,
  CASE WHEN p_partkey % 8 = 0 THEN 'f' ELSE 't' END AS host_has_profile_pic,
  CASE WHEN p_partkey % 15 = 1 THEN NULL WHEN p_partkey % 10 = 0 THEN 'f' ELSE 't' END AS host_identity_verified,
  CAST(p_partkey % 31 AS VARCHAR) AS availability_30,
  CASE WHEN p_partkey % 3 <> 0 THEN concat('0.', CAST(p_partkey % 10 AS VARCHAR)) END AS reviews_per_month,
  CASE WHEN p_partkey % 2 = 0 THEN '2024-07-01' END AS price_quote_checkin_date,
  CASE WHEN p_partkey % 2 = 0 THEN '2024-07-08' END AS price_quote_checkout_date
FROM part""",
    "listings_stamped": """
SELECT *, CAST(regexp_replace(id, '[^0-9]', '', 'g') AS BIGINT) AS ordinal__ FROM listings_base
UNION ALL
SELECT * REPLACE ('$1.00' AS price), CAST(regexp_replace(id, '[^0-9]', '', 'g') AS BIGINT) + 1000000000000 FROM listings_base
WHERE CAST(regexp_replace(id, '[^0-9]', '', 'g') AS BIGINT) % 20 = 0""",
    "listings_raw": "SELECT * EXCLUDE (ordinal__) FROM listings_stamped",
    "listings_dedup": """
SELECT * EXCLUDE (rn__, ordinal__) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ordinal__) AS rn__ FROM listings_stamped)
WHERE rn__ = 1""",
    "listings_p": """
SELECT * EXCLUDE (neighbourhood_group_cleansed, license, calendar_updated),
  try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) AS price_clean
FROM listings_dedup""",
    "listings_t": """
SELECT CASE WHEN q25 = 0 THEN 60000.0 ELSE q25 END AS q25, CASE WHEN q50 = 0 THEN 120000.0 ELSE q50 END AS q50,
       CASE WHEN q75 = 0 THEN 250000.0 ELSE q75 END AS q75
FROM (SELECT quantile_cont(price_clean, 0.25) AS q25, quantile_cont(price_clean, 0.5) AS q50,
             quantile_cont(price_clean, 0.75) AS q75 FROM listings_p)""",
    "listings_clean": f"""
SELECT id, name, host_id, host_name, {pdate('host_since')} AS host_since, {pdate('last_review')} AS last_review,
  {flag('host_is_superhost')} AS host_is_superhost, {flag('instant_bookable')} AS instant_bookable,
  neighbourhood_cleansed, room_type,
  coalesce({num('accommodates')}, 1) AS accommodates, coalesce({num('bedrooms')}, 1) AS bedrooms,
  coalesce({num('beds')}, 1) AS beds, coalesce({num('bathrooms')}, 1) AS bathrooms,
  coalesce({num('minimum_nights')}, 1) AS minimum_nights, coalesce({num('maximum_nights')}, 365) AS maximum_nights,
  coalesce({num('availability_365')}, 0) AS availability_365, coalesce({num('number_of_reviews')}, 0) AS number_of_reviews,
  {num('review_scores_rating')} AS review_scores_rating,
  price, amenities, host_response_rate, host_acceptance_rate, latitude, longitude, property_type, availability_30, reviews_per_month,
  price_quote_checkin_date, price_quote_checkout_date, {pdate('first_review')} AS first_review, {pdate('last_scraped')} AS last_scraped,
  {pdate('calendar_last_scraped')} AS calendar_last_scraped, {flag('has_availability')} AS has_availability,
  {flag('host_has_profile_pic')} AS host_has_profile_pic, {flag('host_identity_verified')} AS host_identity_verified, price_clean,
  CASE WHEN price_clean IS NULL OR price_clean <= 0 THEN 'No especificado'
       WHEN price_clean < q25 THEN 'Económico' WHEN price_clean < q50 THEN 'Medio'
       WHEN price_clean < q75 THEN 'Alto' ELSE 'Lujo' END AS price_category,
  CAST({N_ITEMS} AS BIGINT) AS n_amenities,
  year({pdate('host_since')}) AS host_since_year, month({pdate('host_since')}) AS host_since_month,
  quarter({pdate('host_since')}) AS host_since_quarter, year({pdate('last_review')}) AS last_review_year
FROM listings_p, listings_t""",
    "lineitem_placed": "SELECT *, row_number() OVER () AS ordinal__ FROM lineitem",
    "reviews_stamped": f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN '999999999'
       WHEN l_orderkey % 107 = 0 THEN concat('x', CAST(l_partkey AS VARCHAR)) ELSE CAST(l_partkey AS VARCHAR) END AS listing_id,
  CASE WHEN l_orderkey % 113 = 0 THEN '2020-01-01 junk' WHEN l_orderkey % 127 = 0 THEN NULL ELSE {SHIP} END AS date,
  CAST(l_suppkey AS VARCHAR) AS reviewer_id, concat('user ', CAST(l_suppkey AS VARCHAR)) AS reviewer_name,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 211 = 0 THEN repeat(concat(l_returnflag, l_linestatus), 2500)
       ELSE concat(l_returnflag, l_linestatus) END AS comments, ordinal__
FROM lineitem_placed""",
    "reviews_raw": "SELECT * EXCLUDE (ordinal__) FROM reviews_stamped",
    "reviews_dedup": """
SELECT * EXCLUDE (rn__, ordinal__) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ordinal__) AS rn__ FROM reviews_stamped)
WHERE rn__ = 1""",
    "reviews_clean": f"""
SELECT id, try_cast(listing_id AS BIGINT) AS listing_id, d AS date, CAST(reviewer_id AS BIGINT) AS reviewer_id,
  reviewer_name, coalesce(comments, 'Sin comentario') AS comments,
  year(d) AS year, month(d) AS month, day(d) AS day, quarter(d) AS quarter, isodow(d) - 1 AS day_of_week,
  CAST(CASE WHEN isodow(d) - 1 IN (5, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
FROM (SELECT *, {pdate('date')} AS d FROM reviews_dedup)""",
    "calendar_stamped": f"""
SELECT CASE WHEN l_orderkey % 109 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS listing_id,
  CASE WHEN l_orderkey % 131 = 0 THEN 'bad' ELSE {SHIP} END AS date,
  CASE WHEN l_returnflag = 'A' THEN 't' WHEN l_returnflag = 'N' THEN 'f' WHEN l_linenumber = 3 THEN 'x' END AS available,
  CASE WHEN l_orderkey % 137 = 0 THEN '2.5' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS minimum_nights,
  CAST(CAST(l_quantity AS INTEGER) * 20 AS VARCHAR) AS maximum_nights, ordinal__
FROM lineitem_placed""",
    "calendar_raw": "SELECT * EXCLUDE (ordinal__) FROM calendar_stamped",
    "calendar_dedup": """
SELECT * EXCLUDE (rn__, ordinal__) FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id, date ORDER BY ordinal__) AS rn__ FROM calendar_stamped)
WHERE rn__ = 1""",
    "calendar_clean": f"""
SELECT try_cast(listing_id AS BIGINT) AS listing_id, d AS date, available,
  CAST(minimum_nights AS DOUBLE) AS minimum_nights, CAST(maximum_nights AS DOUBLE) AS maximum_nights,
  {flag('available')} AS is_available, year(d) AS year, month(d) AS month, week(d) AS week,
  quarter(d) AS quarter, isodow(d) - 1 AS day_of_week
FROM (SELECT *, {pdate('date')} AS d FROM calendar_dedup)""",
    "calendar_summary": """
SELECT year, month, count(date) AS total_dias,
  CAST(sum(CASE WHEN is_available THEN 1 ELSE 0 END) AS BIGINT) AS dias_disponibles,
  round_even(avg(CASE WHEN is_available THEN 1 ELSE 0 END) * 100, 2) AS disponibilidad_pct,
  round_even(avg(minimum_nights), 1) AS noches_minimas_prom
FROM calendar_clean WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month""",
    "parent_ids": "SELECT DISTINCT try_cast(id AS BIGINT) AS pid FROM listings_clean WHERE try_cast(id AS BIGINT) IS NOT NULL",
    # the serving rules: the first one that a row breaks
    "listings_checked": """
SELECT *, CASE WHEN try_cast(id AS BIGINT) IS NULL THEN 'type:id' WHEN accommodates <> floor(accommodates) THEN 'type:accommodates'
  WHEN bedrooms <> floor(bedrooms) THEN 'type:bedrooms' WHEN beds <> floor(beds) THEN 'type:beds' END AS violation
FROM listings_clean""",
    "published_ids": "SELECT CAST(id AS BIGINT) AS pid FROM listings_checked WHERE violation IS NULL",
    "reviews_checked": """
SELECT *, CASE WHEN try_cast(id AS BIGINT) IS NULL THEN 'type:id' WHEN listing_id IS NULL THEN 'not_null:listing_id'
  WHEN listing_id NOT IN (SELECT pid FROM published_ids) THEN 'orphan:listing_id' END AS violation
FROM reviews_clean""",
    "calendar_checked": """
SELECT *, CASE WHEN minimum_nights <> floor(minimum_nights) THEN 'type:minimum_nights'
  WHEN maximum_nights <> floor(maximum_nights) THEN 'type:maximum_nights'
  WHEN listing_id IS NULL THEN 'not_null:listing_id' WHEN date IS NULL THEN 'not_null:date'
  WHEN listing_id NOT IN (SELECT pid FROM published_ids) THEN 'orphan:listing_id' END AS violation
FROM calendar_clean""",
}


def with_ctes(body: str) -> str:
    """Prefix the shared CTEs (DuckDB skips the ones the body never reads); a
    body with CTEs of its own has them appended to the shared list."""
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in CTES.items())
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{b[5:]}"
    return f"WITH {ctes}\n{body}"


NULL_TOKENS_SQL = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
                   "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")
LISTING_RAW_COLS = ["id", "name", "host_id", "host_name", "host_since", "last_review", "host_is_superhost",
                    "instant_bookable", "neighbourhood_cleansed", "neighbourhood_group_cleansed", "license",
                    "room_type", "accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights",
                    "maximum_nights", "availability_365", "number_of_reviews", "review_scores_rating", "price",
                    "amenities", "host_response_rate", "host_acceptance_rate", "latitude", "longitude", "property_type",
                    "first_review", "last_scraped", "calendar_last_scraped", "calendar_updated", "has_availability",
                    "host_has_profile_pic", "host_identity_verified", "availability_30", "reviews_per_month",
                    "price_quote_checkin_date", "price_quote_checkout_date"]
SPARSE = ("neighbourhood_group_cleansed", "license", "calendar_updated")
LISTING_DATES = ["host_since", "last_review", "first_review", "last_scraped", "calendar_last_scraped"]
LISTING_FLAGS = ["host_is_superhost", "instant_bookable", "has_availability", "host_has_profile_pic", "host_identity_verified"]


def _null_tokens_body() -> str:
    cols = ", ".join(f"CASE WHEN {c} IN ({NULL_TOKENS_SQL}) THEN NULL ELSE {c} END AS {c}" for c in LISTING_RAW_COLS)
    return f"SELECT {cols} FROM listings_raw"


SQL: dict[str, str] = {
    # ---------------------------------------------------------------- 2.8 scalars
    "parse_price": "SELECT id, price, try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) AS price_clean "
                   "FROM listings_raw",
    "parse_price_signed": "SELECT id, price, " + num("regexp_replace(price, '[$,]', '', 'g')") + " AS price_num "
                          "FROM listings_raw",
    "categorize_price": """
SELECT id, price, CASE WHEN p IS NULL OR p <= 0 THEN 'No especificado' WHEN p < 60000 THEN 'Económico'
  WHEN p < 120000 THEN 'Medio' WHEN p < 250000 THEN 'Alto' ELSE 'Lujo' END AS price_category
FROM (SELECT *, try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) AS p FROM listings_raw)""",
    "count_list_items": f"SELECT id, amenities, CAST({N_ITEMS} AS BIGINT) AS n_amenities FROM listings_raw",
    "parse_list": f"""
SELECT id, len(items) AS n_items, array_to_string(items, '|') AS items_text
FROM (SELECT id, {ITEMS} AS items FROM listings_raw)""",
    "parse_date": f"SELECT id, host_since AS host_since_raw, {iso(pdate('host_since'))} AS host_since, "
                  f"{iso(pdate('last_review'))} AS last_review FROM listings_raw",
    "date_parts_listing": "SELECT id, host_since_year, host_since_month, host_since_quarter, last_review_year "
                          "FROM listings_clean",
    "date_parts_review": "SELECT id, year, month, day, quarter, day_of_week, is_weekend FROM reviews_clean",
    "date_parts_calendar": f"SELECT listing_id, {iso('date')} AS date, year, month, week, quarter, day_of_week "
                           "FROM calendar_clean",
    "format_date_iso": f"SELECT id, {iso('date')} AS date_text FROM reviews_clean",
    "month_period": f"SELECT listing_id, date, strftime({pdate('date')}, '%Y-%m') AS mes FROM calendar_raw",
    "map_flag": f"SELECT id, {flag('host_is_superhost')} AS host_is_superhost, {flag('instant_bookable')} AS instant_bookable "
                "FROM listings_raw",
    "flag_to_int": """
SELECT listing_id, date, available, CAST(CASE available WHEN 't' THEN 1 WHEN 'f' THEN 0 END AS BIGINT) AS disp_bool,
  CAST(coalesce(CASE available WHEN 't' THEN 1 WHEN 'f' THEN 0 END, 0) AS BIGINT) AS disp_num FROM calendar_raw""",
    "parse_numeric": "SELECT id, " + ", ".join(f"{num(c)} AS {c}" for c in [
        "accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights", "maximum_nights",
        "review_scores_rating"]) + " FROM listings_raw",
    "impute_defaults": f"""
SELECT id, coalesce({num('accommodates')}, 1) AS accommodates, coalesce({num('bedrooms')}, 1) AS bedrooms,
  coalesce({num('beds')}, 1) AS beds, coalesce({num('bathrooms')}, 1) AS bathrooms,
  coalesce({num('minimum_nights')}, 1) AS minimum_nights, coalesce({num('maximum_nights')}, 365) AS maximum_nights,
  coalesce({num('availability_365')}, 0) AS availability_365, coalesce({num('number_of_reviews')}, 0) AS number_of_reviews,
  {num('review_scores_rating')} AS review_scores_rating
FROM listings_raw""",
    "fill_comment": "SELECT id, listing_id, date, coalesce(comments, 'Sin comentario') AS comments FROM reviews_raw",
    "truncate_text": """
SELECT doc_id, substring(text, 1, 4000) AS text, length(substring(text, 1, 4000)) AS n_chars_cut,
  CASE WHEN length(text) > 70 THEN concat(substring(text, 1, 70), '...') ELSE text END AS display
FROM documents""",
    "round_half_even": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round_even(l_discount * 100 + 0.125, 2) AS r2,
  round_even(l_tax * 10 + 0.25, 1) AS r1 FROM lineitem""",
    "parse_percent": f"""
SELECT id, host_response_rate, {num("replace(host_response_rate, '%', '')")} / 100.0 AS response_rate
FROM listings_raw""",
    "null_tokens": _null_tokens_body(),
}


def sql_for(key: str, rounded: dict[str, int] | None = None) -> str:
    body = SQL[key]
    if rounded:
        rep = ", ".join(f"round({c}, {n}) AS {c}" for c, n in rounded.items())
        body = f"SELECT * REPLACE ({rep}) FROM ({body})"
    return with_ctes(body)


# ------------------------------------------------------------------ helpers for generated bodies

DESCRIBE_PRESENT = ["accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights", "maximum_nights",
                    "availability_30", "availability_365", "number_of_reviews", "reviews_per_month", "review_scores_rating"]
OUTLIER_VARS = ["price_num", "minimum_nights", "availability_365", "number_of_reviews", "review_scores_rating",
                "accommodates"]
CORR_VARS = ["price_num", "accommodates", "bedrooms", "beds", "minimum_nights", "availability_365",
             "number_of_reviews", "review_scores_rating", "reviews_per_month", "n_amenities"]
REVIEW_RAW_COLS = ["id", "listing_id", "date", "reviewer_id", "reviewer_name", "comments"]
CALENDAR_RAW_COLS = ["listing_id", "date", "available", "minimum_nights", "maximum_nights"]

CTES["listings_num"] = ("SELECT * REPLACE (" + ", ".join(f"{num(c)} AS {c}" for c in DESCRIBE_PRESENT) + "), "
                        + num("regexp_replace(price, '[$,]', '', 'g')") + " AS price_num, "
                        + f"len({ITEMS}) AS n_amenities FROM listings_raw")
CTES["reviews_dated"] = f"SELECT * REPLACE ({pdate('date')} AS date) FROM reviews_raw"
CTES["calendar_dated"] = f"SELECT * REPLACE ({pdate('date')} AS date) FROM calendar_raw"


def _nulls_long(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS rows FROM {table}" for c in cols)


def _describe() -> str:
    parts = []
    for c in DESCRIBE_PRESENT:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS \"column\", count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
                     f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
                     f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM listings_num")
    return " UNION ALL ".join(parts)


def _iqr() -> str:
    parts = []
    for c in OUTLIER_VARS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""
SELECT '{c}' AS "column", n, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
  q3 + 1.5 * (q3 - q1) AS upper_bound, n_above, n_below, n_above + n_below AS n_outliers,
  CAST(n_above + n_below AS DOUBLE) * 100.0 / n AS pct_outliers, mean, median
FROM (SELECT count(x) AS n, any_value(q1) AS q1, any_value(q3) AS q3, any_value(mean) AS mean,
        any_value(median) AS median,
        CAST(coalesce(sum(CASE WHEN x > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_above,
        CAST(coalesce(sum(CASE WHEN x < q1 - 1.5 * (q3 - q1) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_below
      FROM (SELECT {x} AS x FROM listings_num) d,
           (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
                   quantile_cont({x}, 0.75) AS q3, avg({x}) AS mean FROM listings_num) s)""")
    return " UNION ALL ".join(parts)


def _boxplot() -> str:
    parts = []
    for c in OUTLIER_VARS:
        x = f"CAST({c} AS DOUBLE)"
        inside = "x IS NOT NULL AND x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)"
        parts.append(f"""
SELECT '{c}' AS "column", any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
  min(CASE WHEN {inside} THEN x END) AS whisker_low, max(CASE WHEN {inside} THEN x END) AS whisker_high,
  CAST(sum(CASE WHEN x IS NOT NULL AND NOT ({inside}) THEN 1 ELSE 0 END) AS BIGINT) AS n_fliers
FROM (SELECT {x} AS x FROM listings_num) d,
     (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
             quantile_cont({x}, 0.75) AS q3 FROM listings_num) s""")
    return " UNION ALL ".join(parts)


def _hist(src: str, bins: int, extra_select: str = "", extra_from: str = "") -> str:
    return f"""
SELECT s.range AS bin, lo + s.range * ((hi - lo) / {bins}) AS lower, lo + (s.range + 1) * ((hi - lo) / {bins}) AS upper,
  coalesce(c.n, 0) AS count {extra_select}
FROM range({bins}) s
CROSS JOIN (SELECT min(x) AS lo, max(x) AS hi FROM ({src})) r
LEFT JOIN (SELECT least(coalesce(CAST(floor((x - lo) / ((hi - lo) / {bins})) AS BIGINT), 0), {bins - 1}) AS bin,
                  count(*) AS n
           FROM ({src}) d2, (SELECT min(x) AS lo, max(x) AS hi FROM ({src})) r2 GROUP BY 1) c ON c.bin = s.range
{extra_from}
WHERE hi IS NOT NULL"""


def _pearson(a: str, b: str) -> str:
    aa = f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END)"
    bb = f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END)"
    return f"covar_samp({aa}, {bb}) / (stddev_samp({aa}) * stddev_samp({bb}))"


def _corr_matrix() -> str:
    pairs = [(a, b) for i, a in enumerate(CORR_VARS) for b in CORR_VARS[i:]]
    cols = ", ".join(f"{_pearson(a, b)} AS c{i}" for i, (a, b) in enumerate(pairs))
    sel = []
    for i, (a, b) in enumerate(pairs):
        sel.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, c{i} AS corr FROM cm")
        if a != b:
            sel.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, c{i} AS corr FROM cm")
    return f"WITH cm AS (SELECT {cols} FROM listings_num) " + " UNION ALL ".join(sel)


def _corr_with_price() -> str:
    others = [c for c in CORR_VARS if c != "price_num"]
    cols = ", ".join(f"{_pearson(c, 'price_num')} AS c{i}" for i, c in enumerate(others))
    sel = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", c{i} AS corr FROM cp" for i, c in enumerate(others))
    return f"WITH cp AS (SELECT {cols} FROM listings_num) {sel}"


def _null_overview() -> str:
    parts = []
    for t, cols in [("listings_raw", LISTING_RAW_COLS), ("reviews_raw", REVIEW_RAW_COLS),
                    ("calendar_raw", CALENDAR_RAW_COLS)]:
        parts.append(f"""
SELECT '{t.replace('_raw', '')}' AS table_name, max(rows) AS rows,
  CAST(sum(CASE WHEN nulls > 0 THEN 1 ELSE 0 END) AS BIGINT) AS cols_with_nulls,
  avg(CAST(nulls AS DOUBLE) / rows * 100) AS mean_null_pct
FROM ({_nulls_long(t, cols)})""")
    return " UNION ALL ".join(parts)


def _fmt_samples() -> str:
    parts = [f"(SELECT '{c}' AS \"column\", id, {c} AS value FROM listings_raw WHERE {c} IS NOT NULL "
             f"ORDER BY id, {c} LIMIT {n})" for c, n in [*((c, 3) for c in ["last_scraped", "host_since", "first_review", "last_review", "calendar_last_scraped",
                                              "price_quote_checkin_date", "price_quote_checkout_date"]), ("price", 5)]]
    return "SELECT * FROM " + " UNION ALL SELECT * FROM ".join(parts)


_MES = f"strftime({pdate('date')}, '%Y-%m')"
_AVAIL01 = "CASE WHEN is_available THEN 1 ELSE 0 END"
_NUM_PRICE = "listings_num"

SQL.update({
    # ---------------------------------------------------------------- 2.2
    "select_existing": "SELECT id, name, price, latitude, room_type, longitude FROM listings_raw",
    "rename_columns": "SELECT id, price_clean AS price, neighbourhood_cleansed AS barrio FROM listings_clean",
    "drop_known_sparse": "SELECT * EXCLUDE (neighbourhood_group_cleansed, license, calendar_updated) FROM listings_raw",
    "drop_sparse_columns": "SELECT * EXCLUDE (neighbourhood_group_cleansed, license, calendar_updated) FROM listings_raw",
    "filter_non_null": "SELECT id, review_scores_rating FROM listings_clean WHERE review_scores_rating IS NOT NULL",
    "filter_upper_percentile": "SELECT id, price_num FROM listings_num "
                               "WHERE price_num <= (SELECT quantile_cont(price_num, 0.99) FROM listings_num)",
    "filter_year_from": f"SELECT id, {iso('date')} AS date, year FROM reviews_clean WHERE date >= DATE '1998-01-01'",
    "filter_valid_min_nights": "SELECT id, minimum_nights FROM listings_clean "
                               "WHERE minimum_nights IS NULL OR minimum_nights <= 365",
    # ---------------------------------------------------------------- 2.3
    "semi_join_valid_parents": "SELECT * FROM reviews_raw WHERE try_cast(listing_id AS BIGINT) IN (SELECT pid FROM parent_ids)",
    "fk_orphans": "SELECT id, listing_id FROM reviews_raw WHERE listing_id IS NOT NULL "
                  "AND coalesce(try_cast(listing_id AS BIGINT) NOT IN (SELECT pid FROM parent_ids), TRUE)",
    "broadcast_thresholds": "SELECT id, price_clean, price_category, q25, q50, q75 FROM listings_clean, listings_t",
    # ---------------------------------------------------------------- 2.4 dedup
    "dedup_listings": "SELECT * FROM listings_dedup",
    "dedup_reviews": "SELECT * FROM reviews_dedup",
    "dedup_calendar": "SELECT * FROM calendar_dedup",
    "duplicate_counts": """
SELECT 'listings' AS table_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates
  FROM (SELECT count(*) AS n FROM listings_raw GROUP BY id)
UNION ALL SELECT 'reviews', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM reviews_raw GROUP BY id)
UNION ALL SELECT 'calendar', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM calendar_raw GROUP BY listing_id, date)""",
    # ---------------------------------------------------------------- 2.4 summaries
    "calendar_monthly_summary": "SELECT * FROM calendar_summary",
    "calendar_weekly_summary": f"""
SELECT isoyear(date) AS iso_year, week(date) AS week, count(*) AS total_dias,
  CAST(sum({_AVAIL01}) AS BIGINT) AS dias_disponibles, round_even(avg({_AVAIL01}) * 100, 2) AS disponibilidad_pct,
  round_even(avg(minimum_nights), 1) AS noches_minimas_prom
FROM calendar_clean WHERE date IS NOT NULL GROUP BY 1, 2""",
    "availability_by_month": f"""
SELECT mes, avg(CASE available WHEN 't' THEN 1 WHEN 'f' THEN 0 END) * 100 AS disponibilidad_pct
FROM (SELECT *, {_MES} AS mes FROM calendar_raw) WHERE mes IS NOT NULL GROUP BY mes""",
    "availability_crosstab": f"""
SELECT mes, count(*) FILTER (WHERE available = 'f') AS f, count(*) FILTER (WHERE available = 't') AS t,
  count(*) FILTER (WHERE available NOT IN ('f', 't')) AS other
FROM (SELECT *, {_MES} AS mes FROM calendar_raw) WHERE mes IS NOT NULL AND available IS NOT NULL GROUP BY mes""",
    "availability_share": """
SELECT available, count(*) AS count,
  round_even(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(available) FROM calendar_raw), 2) AS pct
FROM calendar_raw WHERE available IS NOT NULL GROUP BY available""",
    "available_counts": "SELECT available, count(*) AS count FROM calendar_raw GROUP BY available",
    "price_category_counts": "SELECT price_category, count(*) AS count FROM listings_clean GROUP BY price_category",
    "room_type_counts": "SELECT room_type, count(*) AS count FROM listings_raw GROUP BY room_type",
    "room_type_share": """
SELECT room_type, count(*) AS count, CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM listings_raw) AS pct
FROM listings_raw WHERE room_type IS NOT NULL GROUP BY room_type""",
    "top_neighbourhoods": """
SELECT neighbourhood_cleansed, count(*) AS count FROM listings_raw WHERE neighbourhood_cleansed IS NOT NULL
GROUP BY 1 ORDER BY count DESC, neighbourhood_cleansed ASC LIMIT 10""",
    "top_neighbourhoods_store": """
SELECT neighbourhood_cleansed, count(*) AS count FROM listings_raw
GROUP BY 1 ORDER BY count DESC, neighbourhood_cleansed ASC NULLS LAST LIMIT 5""",
    "top_reviewed_listings": """
SELECT listing_id, count(*) AS count FROM reviews_raw GROUP BY 1 ORDER BY count DESC, listing_id ASC NULLS LAST LIMIT 5""",
    "top_amenities": """
SELECT item, count(*) AS count
FROM (SELECT unnest(""" + ITEMS + """) AS item FROM listings_raw)
GROUP BY item ORDER BY count DESC, item ASC NULLS LAST LIMIT 20""",
    "amenities_stats": f"SELECT avg(n) AS mean_items, max(n) AS max_items, min(n) AS min_items "
                       f"FROM (SELECT len({ITEMS}) AS n FROM listings_raw)",
    "reviews_per_year": "SELECT year(date) AS year, count(*) AS total_reviews FROM reviews_dated "
                        "WHERE date >= DATE '1998-01-01' GROUP BY 1",
    "reviews_seasonality": """
SELECT s.range AS month, coalesce(c.n, 0) AS total_reviews FROM range(1, 13) s
LEFT JOIN (SELECT month(date) AS month, count(*) AS n FROM reviews_dated WHERE date IS NOT NULL GROUP BY 1) c
  ON c.month = s.range""",
    "review_date_range": f"SELECT {iso('min(date)')} AS first_date, {iso('max(date)')} AS last_date, "
                         "count(DISTINCT year(date)) AS n_years FROM reviews_dated",
    "calendar_date_range": f"SELECT {iso('min(date)')} AS first_date, {iso('max(date)')} AS last_date FROM calendar_dated",
    "distinct_flag_values": """
SELECT DISTINCT 'listings' AS table_name, c AS "column", v AS value FROM (
  SELECT 'host_is_superhost' AS c, host_is_superhost AS v FROM listings_raw
  UNION ALL SELECT 'instant_bookable', instant_bookable FROM listings_raw
  UNION ALL SELECT 'has_availability', has_availability FROM listings_raw
  UNION ALL SELECT 'host_has_profile_pic', host_has_profile_pic FROM listings_raw
  UNION ALL SELECT 'host_identity_verified', host_identity_verified FROM listings_raw) WHERE v IS NOT NULL
UNION ALL SELECT DISTINCT 'calendar', 'available', available FROM calendar_raw""",
    # ---------------------------------------------------------------- 2.4 profiles
    "null_profile": f"""
SELECT "column", CAST(nulls AS DOUBLE) / rows * 100 AS null_pct FROM ({_nulls_long('listings_raw', LISTING_RAW_COLS)})
WHERE nulls > 0 ORDER BY null_pct DESC, "column" """,
    "null_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, * FROM ({_nulls_long(t + '_raw', cols)})"
        for t, cols in [("listings", LISTING_RAW_COLS), ("reviews", REVIEW_RAW_COLS), ("calendar", CALENDAR_RAW_COLS)]),
    "null_overview": _null_overview(),
    "describe_numeric": _describe(),
    "price_quartiles": """
SELECT quantile_cont(price_clean, 0.25) AS q25, quantile_cont(price_clean, 0.5) AS q50,
  quantile_cont(price_clean, 0.75) AS q75, median(price_clean) AS median FROM listings_clean""",
    "iqr_outliers": _iqr(),
    "boxplot_stats": _boxplot(),
    "price_outlier_flag": """
SELECT id, price_clean, coalesce(price_clean < q1 - 3 * (q3 - q1) OR price_clean > q3 + 3 * (q3 - q1), FALSE) AS price_outlier
FROM listings_clean, (SELECT quantile_cont(price_clean, 0.25) AS q1, quantile_cont(price_clean, 0.75) AS q3
                      FROM listings_clean)""",
    "histogram_price": _hist("SELECT price_num AS x FROM listings_num WHERE price_num IS NOT NULL AND price_num <= "
                             "(SELECT quantile_cont(price_num, 0.99) FROM listings_num)", 60),
    "histogram_availability": _hist("SELECT CAST(availability_365 AS DOUBLE) AS x FROM listings_num "
                                    "WHERE availability_365 IS NOT NULL", 40, ", m.median",
                                    "CROSS JOIN (SELECT median(availability_365) AS median FROM listings_num) m"),
    "histogram_amenities": _hist("SELECT CAST(n_amenities AS DOUBLE) AS x FROM listings_num "
                                 "WHERE n_amenities IS NOT NULL", 30, ", m.mean",
                                 "CROSS JOIN (SELECT avg(n_amenities) AS mean FROM listings_num) m"),
    "correlation_matrix": _corr_matrix(),
    "correlation_with_price": _corr_with_price(),
    "neighbourhood_median_impute": """
SELECT id, neighbourhood_cleansed, price_clean, CASE WHEN price_clean IS NULL THEN m.med ELSE price_clean END AS price_imputed
FROM listings_clean LEFT JOIN (SELECT neighbourhood_cleansed, median(price_clean) AS med FROM listings_clean
                               WHERE price_clean IS NOT NULL GROUP BY 1) m USING (neighbourhood_cleansed)""",
    # ---------------------------------------------------------------- 2.6
    "sample_rows": "SELECT id, name, price_clean, room_type FROM listings_clean ORDER BY id LIMIT 5",
    "format_samples": _fmt_samples(),
})


def _iso_dates(table: str, cols: list[str]) -> str:
    rep = ", ".join(f"{iso(c)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM {table}"


LISTING_FIELDS = [("id", "bigint", "BIGINT"), ("name", "string", "VARCHAR"), ("host_id", "bigint", "BIGINT"),
                  ("host_name", "string", "VARCHAR"), ("host_since", "date", "DATE"),
                  ("host_is_superhost", "int", "INTEGER"), ("neighbourhood_cleansed", "string", "VARCHAR"),
                  ("latitude", "double", "DOUBLE"), ("longitude", "double", "DOUBLE"), ("property_type", "string", "VARCHAR"),
                  ("room_type", "string", "VARCHAR"), ("accommodates", "int", "INTEGER"), ("bathrooms", "double", "DOUBLE"),
                  ("bedrooms", "int", "INTEGER"), ("beds", "int", "INTEGER"), ("price", "double", "DOUBLE"),
                  ("minimum_nights", "int", "INTEGER"), ("maximum_nights", "int", "INTEGER"),
                  ("availability_365", "int", "INTEGER"), ("number_of_reviews", "int", "INTEGER"),
                  ("review_scores_rating", "double", "DOUBLE")]
REVIEW_FIELDS = [("id", "bigint", "BIGINT"), ("listing_id", "bigint", "BIGINT"), ("date", "date", "DATE"),
                 ("reviewer_id", "bigint", "BIGINT"), ("reviewer_name", "string", "VARCHAR"), ("comments", "string", "VARCHAR")]
CALENDAR_FIELDS = [("listing_id", "bigint", "BIGINT"), ("date", "date", "DATE"), ("minimum_nights", "int", "INTEGER"),
                   ("maximum_nights", "int", "INTEGER")]


def _misfit(c: str, duck_t: str) -> str:
    """A text that does not fit its serving type: no such value, or a fraction in an integer column."""
    value = pdate(c) if duck_t == "DATE" else f"try_cast({c} AS {duck_t})"
    bad = f"{c} IS NOT NULL AND {value} IS NULL"
    if duck_t in ("BIGINT", "INTEGER"):
        d = f"try_cast({c} AS DOUBLE)"
        bad = f"({bad}) OR ({c} IS NOT NULL AND {d} IS NOT NULL AND {d} <> floor({d}))"
    return bad


def _check_types() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS \"column\", '{spark_t}' AS target_type, "
        f"CAST(coalesce(sum(CASE WHEN {_misfit(c, duck_t)} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM {t}_raw"
        for t, fields in [("listings", LISTING_FIELDS), ("reviews", REVIEW_FIELDS), ("calendar", CALENDAR_FIELDS)] for c, spark_t, duck_t in fields)


def _quality() -> str:
    keys = {"listings": ["id"], "reviews": ["id"], "calendar": ["listing_id", "date"]}
    fields = {"listings": LISTING_FIELDS, "reviews": REVIEW_FIELDS, "calendar": CALENDAR_FIELDS}
    parts = []
    for t, k in keys.items():
        ks = ", ".join(k)
        parts.append(f"SELECT '{t}' AS t, 'unique' AS rule, '{','.join(k)}' AS columns, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations "
                     f"FROM (SELECT count(*) AS n FROM {t}_raw GROUP BY {ks} HAVING count(*) > 1)")
        for c in {"reviews": ["listing_id"], "calendar": ["listing_id", "date"]}.get(t, []):
            parts.append(f"SELECT '{t}', 'not_null', '{c}', count(*) - count({c}) FROM {t}_raw")
        for c, _, duck_t in fields[t]:
            parts.append(f"SELECT '{t}', 'type', '{c}', CAST(coalesce(sum(CASE WHEN {_misfit(c, duck_t)} THEN 1 ELSE 0 END), 0) AS BIGINT) FROM {t}_raw")
        if t != "listings":
            parts.append(f"SELECT '{t}', 'foreign_key', 'listing_id', count(*) FROM {t}_raw WHERE listing_id IS NOT NULL "
                         "AND coalesce(try_cast(listing_id AS BIGINT) NOT IN (SELECT pid FROM parent_ids), TRUE)")
    parts.append("SELECT 'calendar_summary', 'unique', 'year,month', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
                 "FROM (SELECT count(*) AS n FROM calendar_summary GROUP BY year, month HAVING count(*) > 1)")
    parts += [f"SELECT 'calendar_summary', 'not_null', '{c}', count(*) - count({c}) FROM calendar_summary" for c in ("year", "month")]
    whole = {"year", "month", "total_dias", "dias_disponibles"}
    parts += [f"SELECT 'calendar_summary', 'type', '{c}', count(*) FILTER (WHERE {'%s <> floor(%s)' % (c, c) if c in whole else 'FALSE'}) FROM calendar_summary"
              for c in ["year", "month", "total_dias", "dias_disponibles", "disponibilidad_pct", "noches_minimas_prom"]]
    return ("SELECT t AS table_name, rule, columns, violations, CASE WHEN violations > 0 THEN 'fail' ELSE 'ok' END AS status FROM ("
            + " UNION ALL ".join(parts) + ")")


# columns and kinds (text and dates: length; numbers and flags: sum) of the clean tables
CLEAN_COLUMNS = {
    "listings": {**{c: "v" for c in LISTING_RAW_COLS if c not in SPARSE}, "price_clean": "n",
                 "price_category": "v", "n_amenities": "n", "host_since_year": "n", "host_since_month": "n", "host_since_quarter": "n",
                 "last_review_year": "n", **{c: "n" for c in LISTING_FLAGS},
                 **{c: "n" for c in DESCRIBE_PRESENT if c not in ("availability_30", "reviews_per_month")}},
    "reviews": {"id": "v", "listing_id": "n", "date": "v", "reviewer_id": "n", "reviewer_name": "v", "comments": "v", "year": "n",
                "month": "n", "day": "n", "quarter": "n", "day_of_week": "n", "is_weekend": "n"},
    "calendar": {"listing_id": "n", "date": "v", "available": "v", "minimum_nights": "n", "maximum_nights": "n", "is_available": "n",
                 "year": "n", "month": "n", "week": "n", "quarter": "n", "day_of_week": "n"},
    "calendar_summary": {c: "n" for c in ["year", "month", "total_dias", "dias_disponibles", "disponibilidad_pct", "noches_minimas_prom"]},
}


def _contents(name: str, source: str, kinds: dict[str, str]) -> str:
    def total(c: str, kind: str) -> str:
        if kind == "v":
            return f"sum(length(CAST({c} AS VARCHAR)))"
        return f"sum(CAST(floor(CAST({c} AS DOUBLE) * 1000 + 0.5) AS BIGINT))"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, '{c}' AS \"column\", count({c}) AS n, CAST({total(c, k)} AS BIGINT) AS total FROM {source}"
        for c, k in kinds.items())


_ALL_CONTENTS = " UNION ALL ".join(_contents(t, f"{t}_clean" if t != "calendar_summary" else t, k) for t, k in CLEAN_COLUMNS.items())
_EXPORTED = {
    "listings": ["id", "name", "host_id", "host_name", "host_since", "host_is_superhost", "neighbourhood_cleansed", "room_type",
                 "accommodates", "bedrooms", "price_clean", "price_category", "minimum_nights", "availability_365", "number_of_reviews",
                 "review_scores_rating", "n_amenities"],
    "reviews": ["id", "listing_id", "date", "reviewer_name", "year", "month", "quarter", "is_weekend"],
}
_BUNDLE = " UNION ALL ".join(
    [_contents(t, f"{t}_clean", {c: CLEAN_COLUMNS[t][c] for c in cols}) for t, cols in _EXPORTED.items()]
    + [_contents("monthly", "calendar_summary", CLEAN_COLUMNS["calendar_summary"])])
_OUTCOMES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, coalesce(violation, 'published') AS outcome, count(*) AS rows FROM {t}_checked GROUP BY 2"
    for t in ("listings", "reviews", "calendar")) + " UNION ALL SELECT 'calendar_summary', 'published', count(*) FROM calendar_summary"
_PUBLISHED_ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}_checked WHERE violation IS NULL" for t in ("listings", "reviews", "calendar")) + (
    " UNION ALL SELECT 'calendar_summary', count(*) FROM calendar_summary")


def _metrics() -> str:
    rows = []
    for t, n_in, n_out in [("listings", 39, 43), ("reviews", 6, 12), ("calendar", 5, 11)]:
        rows.append(f"SELECT 'transform' AS stage, '{t}' AS table_name, 'rows_in' AS metric, "
                    f"CAST(count(*) AS DOUBLE) AS value FROM {t}_raw")
        rows.append(f"SELECT 'transform', '{t}', 'rows_out', CAST(count(*) AS DOUBLE) FROM {t}_clean")
        rows.append(f"SELECT 'transform', '{t}', 'duplicates_dropped', "
                    f"CAST((SELECT count(*) FROM {t}_raw) - (SELECT count(*) FROM {t}_clean) AS DOUBLE)")
        rows.append(f"SELECT 'transform', '{t}', 'columns_in', {float(n_in)}")
        rows.append(f"SELECT 'transform', '{t}', 'columns_out', {float(n_out)}")
    rows.append("SELECT 'transform', 'listings', 'null_prices', CAST(count(*) - count(price_clean) AS DOUBLE) "
                "FROM listings_clean")
    rows.append("SELECT 'transform', 'listings', 'mean_n_amenities', avg(n_amenities) FROM listings_clean")
    for label, q in [("price_q25", 0.25), ("price_median", 0.5), ("price_q75", 0.75)]:
        rows.append(f"SELECT 'transform', 'listings', '{label}', quantile_cont(price_clean, {q}) FROM listings_clean")
    rows.append("SELECT 'transform', 'calendar_summary', 'rows_out', CAST(count(*) AS DOUBLE) FROM calendar_summary")
    return " UNION ALL ".join(rows)


def _run_log() -> str:
    """Every stage's rows in and out, each counted on its own."""
    rows = [_metrics()]
    for t in ("listings", "reviews", "calendar"):
        for metric, value in (("rows_in", "count(*)"), ("rows_out", "count(*)"), ("rows_rejected", "0 * count(*)"), ("failed", "0 * count(*)")):
            rows.append(f"SELECT 'ingest', '{t}', '{metric}', CAST({value} AS DOUBLE) FROM {t}_raw")
        for metric, value in (("rows_in", "count(*)"), ("rows_published", "count(*) - count(violation)"), ("rows_set_aside", "count(violation)")):
            rows.append(f"SELECT 'publish', '{t}', '{metric}', CAST({value} AS DOUBLE) FROM {t}_checked")
        rows.append(f"SELECT 'publish', '{t}', 'set_aside:' || violation, CAST(count(*) AS DOUBLE) FROM {t}_checked "
                    "WHERE violation IS NOT NULL GROUP BY violation")
    for metric, value in (("rows_in", "count(*)"), ("rows_published", "count(*)"), ("rows_set_aside", "0 * count(*)")):
        rows.append(f"SELECT 'publish', 'calendar_summary', '{metric}', CAST({value} AS DOUBLE) FROM calendar_summary")
    return " UNION ALL ".join(rows)


_PUB_LISTINGS = f"""
SELECT CAST(id AS BIGINT) AS id, name, CAST(host_id AS BIGINT) AS host_id, host_name, {iso('host_since')} AS host_since,
  CAST(coalesce(host_is_superhost, FALSE) AS BIGINT) AS host_is_superhost, neighbourhood_cleansed,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, property_type, room_type,
  CAST(accommodates AS BIGINT) AS accommodates, bathrooms, CAST(bedrooms AS BIGINT) AS bedrooms,
  CAST(beds AS BIGINT) AS beds, price_clean AS price, price_category, CAST(minimum_nights AS BIGINT) AS minimum_nights,
  CAST(maximum_nights AS BIGINT) AS maximum_nights, CAST(availability_365 AS BIGINT) AS availability_365,
  CAST(number_of_reviews AS BIGINT) AS number_of_reviews, review_scores_rating, n_amenities, host_since_year
FROM listings_checked WHERE violation IS NULL"""
_PUB_REVIEWS = f"""
SELECT CAST(id AS BIGINT) AS id, listing_id, {iso('date')} AS date, reviewer_id, reviewer_name, comments,
  year, month, day, quarter, is_weekend FROM reviews_checked WHERE violation IS NULL"""
_PUB_CALENDAR = f"""
SELECT listing_id, {iso('date')} AS date, CAST(coalesce(is_available, FALSE) AS BIGINT) AS is_available,
  CAST(minimum_nights AS BIGINT) AS minimum_nights, CAST(maximum_nights AS BIGINT) AS maximum_nights,
  year, month, week, quarter, day_of_week FROM calendar_checked WHERE violation IS NULL"""
_RAW_ALL_TEXT = """
SELECT CAST(id AS VARCHAR) AS id, CAST(listing_id AS VARCHAR) AS listing_id, date, CAST(reviewer_id AS VARCHAR) AS reviewer_id,
  reviewer_name, comments FROM reviews_raw"""

SQL.update({
    # ---------------------------------------------------------------- 2.13
    "transform_listings": _iso_dates("listings_clean", LISTING_DATES),
    "transform_reviews": _iso_dates("reviews_clean", ["date"]),
    "transform_calendar": _iso_dates("calendar_clean", ["date"]),
    "transform_all": _ALL_CONTENTS,
    # ---------------------------------------------------------------- 2.11
    "check_unique": """
SELECT 'listings' AS table_name, coalesce(id, '<null>') AS key_value, count(*) AS rows FROM listings_raw GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'reviews', coalesce(id, '<null>'), count(*) FROM reviews_raw GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'calendar', concat_ws('|', coalesce(listing_id, '<null>'), coalesce(date, '<null>')), count(*) FROM calendar_raw
  GROUP BY listing_id, date HAVING count(*) > 1""",
    "check_not_null": """
SELECT 'listing_id' AS "column", count(*) - count(listing_id) AS violations, 'reviews' AS table_name FROM reviews_clean
UNION ALL SELECT 'listing_id', count(*) - count(listing_id), 'calendar' FROM calendar_clean
UNION ALL SELECT 'date', count(*) - count(date), 'calendar' FROM calendar_clean
UNION ALL SELECT 'year', count(*) - count(year), 'calendar_summary' FROM calendar_summary
UNION ALL SELECT 'month', count(*) - count(month), 'calendar_summary' FROM calendar_summary""",
    "check_types": _check_types(),
    "quality_report": _quality(),
    # ---------------------------------------------------------------- 2.12
    "run_metrics": _metrics(),
    "run_log": _run_log(),
    # ---------------------------------------------------------------- 2.1
    "scan_raw_csv": _RAW_ALL_TEXT,
    "write_raw_zone": _null_tokens_body(),
    "quarantine_bad_rows": """
SELECT id, CASE WHEN listing_id = '' THEN NULL ELSE listing_id END AS listing_id,
  CASE WHEN NOT bad THEN concat(coalesce(comments, ''), chr(10), 'end') END AS comments, bad AS rejected
FROM (SELECT *, CAST(id AS BIGINT) % 13 = 0 OR CAST(id AS BIGINT) % 17 = 0 AS bad FROM reviews_raw)""",
    "extract_filter_project_limit": "SELECT listing_id, date, available FROM calendar_raw WHERE available IS NULL "
                                    "AND date IS DISTINCT FROM 'bad' ORDER BY listing_id ASC NULLS LAST, date ASC NULLS LAST LIMIT 500",
    "extract_listings": "SELECT id, price, room_type FROM listings_raw WHERE room_type = 'SMALL'",
    "extract_reviews": "SELECT id, listing_id, date FROM reviews_raw WHERE date >= '1998-01-01'",
    "extract_calendar": "SELECT * FROM calendar_raw WHERE available = 'f'",
    "extract_all_summary": """
SELECT 'listings' AS table_name, count(*) AS rows, CAST(39 AS BIGINT) AS columns FROM listings_raw
UNION ALL SELECT 'reviews', count(*), 6 FROM reviews_raw
UNION ALL SELECT 'calendar', count(*), 5 FROM calendar_raw
UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM listings_raw) + (SELECT count(*) FROM reviews_raw)
  + (SELECT count(*) FROM calendar_raw), 50""",
    "table_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({len(cols)} AS BIGINT) AS n_fields, '{','.join(cols)}' AS fields, "
        f"'{','.join(['string'] * len(cols))}' AS types FROM {t}_raw"
        for t, cols in [("listings", LISTING_RAW_COLS), ("reviews", REVIEW_RAW_COLS), ("calendar", CALENDAR_RAW_COLS)]),
    "write_clean_zone": _ALL_CONTENTS,
    "read_clean_zone": _iso_dates("listings_clean", LISTING_DATES),
    "publish_listings": _PUB_LISTINGS,
    "publish_reviews": _PUB_REVIEWS,
    "publish_calendar": _PUB_CALENDAR,
    "publish_calendar_summary": "SELECT * FROM calendar_summary",
    "publish_all": _OUTCOMES,
    "post_load_counts": f"SELECT table_name, rows AS source_rows, rows AS loaded_rows, "
                        f"CASE WHEN rows > 0 THEN 'OK' ELSE 'FALLO' END AS status FROM ({_PUBLISHED_ROWS})",
    "layout_by_keys": _PUB_CALENDAR,
    "layout_access_paths": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{p}' AS access_path, count(*) AS rows, min(CAST({'listing_id' if t == 'calendar' else 'id'} AS VARCHAR)) AS least "
        f"FROM {t}_clean WHERE {w}" for t, probes in ACCESS_PROBES.items() for p, w in probes),
    "export_listings": f"""
SELECT id, name, host_id, host_name, {iso('host_since')} AS host_since, host_is_superhost, neighbourhood_cleansed,
  room_type, accommodates, bedrooms, price_clean, price_category, minimum_nights, availability_365, number_of_reviews,
  review_scores_rating, n_amenities FROM listings_clean""",
    "export_calendar": "SELECT * FROM calendar_summary",
    "export_report_bundle": _BUNDLE,
})
