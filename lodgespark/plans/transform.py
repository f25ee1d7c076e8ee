"""The cleaning transforms of the three raw tables and the monthly summary.

Each transform is one lazy plan: Catalyst fuses all the scalar steps into a
single projection; the shuffles are the keep-first deduplication (on the table
key) and, for listings, the price quartiles (a scalar subquery).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgespark import constants as K
from lodgespark import contracts as CT
from lodgespark.functions import scalars as S
from lodgespark.operators import cleaning as C
from lodgespark.operators.quantiles import exact_quantiles
from lodgespark.operators.summaries import calendar_monthly_summary
from lodgespark.session import split_large_stages


def _flag(df: DataFrame, c: str) -> Column:
    if dict(df.dtypes)[c] == "boolean":
        return F.col(c)
    return S.map_flag(c)


def price_thresholds(df: DataFrame, price_col: str = "price_clean") -> Column:
    """(q25, q50, q75) of the non-null prices, each 0 replaced by its
    default, as one struct-valued scalar subquery (one row, computed once)."""
    one = exact_quantiles(df, price_col, [0.25, 0.5, 0.75])
    return one.select(F.struct(
        S.quartile_or_default(F.col("q25"), K.DEFAULT_Q25).alias("q25"),
        S.quartile_or_default(F.col("q50"), K.DEFAULT_Q50).alias("q50"),
        S.quartile_or_default(F.col("q75"), K.DEFAULT_Q75).alias("q75")).alias("t")).scalar()


def _listing_columns(df: DataFrame) -> dict[str, Column]:
    """Per-column cleaning expressions of listings (dates, flags, numerics
    with their defaults), for one fused projection."""
    out: dict[str, Column] = {}
    for c in K.LISTING_DATE_COLUMNS:
        if c in df.columns:
            out[c] = S.parse_date(c)
    for c in K.LISTING_FLAG_COLUMNS:
        if c in df.columns:
            out[c] = _flag(df, c)
    for c, default in K.LISTING_NUMERIC_DEFAULTS.items():
        if c in df.columns:
            v = S.parse_numeric(c)
            out[c] = F.coalesce(v, F.lit(float(default))) if default is not None else v
    return out


def transform_listings(raw: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """dedup on id -> drop sparse -> price -> list size -> dates and parts ->
    flags -> numerics with defaults, in one projection, and the category by
    the price quartiles: narrow passes over the deduplicated prices alone,
    which share their exchange."""
    split_large_stages(raw.sparkSession)
    df = C.drop_known_sparse(C.keep_first(CT.LISTINGS.check(raw), ["id"], order)).drop(C.ORDINAL)
    cols = df.columns
    per_col = _listing_columns(df)
    out = [per_col.get(c, F.col(c)).alias(c) for c in cols]
    out += [S.parse_price("price").alias("price_clean"), S.count_list_items("amenities").alias("n_amenities")]
    if "host_since" in cols:
        hs = S.parse_date("host_since")
        out += [F.year(hs).alias("host_since_year"), F.month(hs).alias("host_since_month"),
                F.quarter(hs).alias("host_since_quarter")]
    if "last_review" in cols:
        out.append(F.year(S.parse_date("last_review")).alias("last_review_year"))
    parsed = df.select(*out)
    # the prices alone are deduplicated and sketched; the thresholds struct is projected once, one scalar subquery
    prices = df.select(S.parse_price("price").alias("price_clean"))
    done = parsed.withColumn("__t", price_thresholds(prices)).withColumn("price_category", S.categorize_price(
        "price_clean", F.col("__t.q25"), F.col("__t.q50"), F.col("__t.q75")))
    names = parsed.columns
    at = names.index("price_clean") + 1
    return done.select(*names[:at], "price_category", *names[at:])


def _with_parsed_date(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` with its date parsed, and that column.  A projection of its own:
    the parts of a date read it, so its text is parsed once a row, not once a part."""
    return df.withColumn("date", S.parse_date("date")), F.col("date")


def transform_reviews(raw: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """dedup on id (when present) -> date and its parts -> comment fill -> ids."""
    CT.REVIEWS.check(raw)
    split_large_stages(raw.sparkSession)
    df = (C.keep_first(raw, ["id"], order) if "id" in raw.columns else raw).drop(C.ORDINAL)
    df, d = _with_parsed_date(df)
    repl = {"comments": S.fill_comment("comments")}
    repl.update({c: S.parse_id(c) for c in ["listing_id", "reviewer_id"] if c in df.columns})
    out = [repl.get(c, F.col(c)).alias(c) for c in df.columns]
    out += [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
            F.quarter(d).alias("quarter"), S.weekday_monday0(d).alias("day_of_week"), S.is_weekend(d).alias("is_weekend")]
    return df.select(*out)


def transform_calendar(raw: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """dedup on (listing_id, raw date text) -> flag -> date and its parts ->
    numeric nights and id."""
    split_large_stages(raw.sparkSession)
    df = C.keep_first(CT.CALENDAR.check(raw), ["listing_id", "date"], order).drop(C.ORDINAL)
    df, d = _with_parsed_date(df)
    repl = {"listing_id": S.parse_id("listing_id")}
    repl.update({c: S.parse_numeric(c) for c in ["minimum_nights", "maximum_nights"] if c in df.columns})
    out = [repl.get(c, F.col(c)).alias(c) for c in df.columns]
    out += [_flag(df, "available").alias("is_available"), F.year(d).alias("year"), F.month(d).alias("month"),
            S.iso_week(d).alias("week"), F.quarter(d).alias("quarter"), S.weekday_monday0(d).alias("day_of_week")]
    return df.select(*out)


def transform_all(raw: Mapping[str, DataFrame], orders: Mapping[str, list[Column]] | None = None) -> dict[str, DataFrame]:
    """Whichever of the three raw tables are present, plus the monthly summary."""
    orders = orders or {}
    out: dict[str, DataFrame] = {}
    if "listings" in raw:
        out["listings"] = transform_listings(raw["listings"], orders.get("listings"))
    if "reviews" in raw:
        out["reviews"] = transform_reviews(raw["reviews"], orders.get("reviews"))
    if "calendar" in raw:
        out["calendar"] = transform_calendar(raw["calendar"], orders.get("calendar"))
        out["calendar_summary"] = calendar_monthly_summary(out["calendar"])
    return out
