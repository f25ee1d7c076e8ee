"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the raw-shaped views of
``lodgespark.fixtures``) and runs the library operator over the whole table.
Results pass through ``edge`` so that both engines compare the same way:
dates as ISO text, integral numbers as bigint, and computed doubles rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, TimestampNTZType, TimestampType)

from lodgespark import constants as K
from lodgespark import fixtures as FX
from lodgespark.functions import scalars as S
from lodgespark.operators import cleaning as C
from lodgespark.operators import profiling as P
from lodgespark.operators import quality as Q
from lodgespark.operators import summaries as SM
from lodgespark.operators.quantiles import exact_quantiles
from lodgespark.plans import transform as T

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ROUNDED: dict[str, dict[str, int]] = {}
FIRST_YEAR = 1998  # first year counted by the per-year review query on the test tables


def query(key: str, rounded: dict[str, int] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[key] = fn
        ROUNDED[key] = dict(rounded or {})
        return fn
    return deco


def edge(df: DataFrame, rounded: dict[str, int] | None = None) -> DataFrame:
    """Dates -> 'yyyy-MM-dd' text; integral -> bigint; float -> double; the
    listed doubles rounded (floating sums differ in the last digits between
    engines)."""
    rounded = rounded or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (FloatType, DoubleType)):
            c = c.cast("double")
            if f.name in rounded:
                c = F.round(c, rounded[f.name])
        elif isinstance(t, BooleanType):
            pass
        out.append(c.alias(f.name))
    return df.select(*out)


def registry() -> dict[str, QueryFn]:
    def wrap(key: str, fn: QueryFn) -> QueryFn:
        return lambda spark, sf_dir: edge(fn(spark, sf_dir), ROUNDED[key])
    return {k: wrap(k, fn) for k, fn in REGISTRY.items()}


# ------------------------------------------------------------------ inputs

_MEMO: dict = {}


def _memo(spark: SparkSession, sf: str, name: str, build):
    """Build something once per session and input folder: the stored raw,
    clean and serving zones, landing files, and plans over them."""
    key = (id(spark), sf, name)
    hit = _MEMO.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, build())
        _MEMO[key] = hit
    return hit[1]


class _PerTable(Mapping):
    """Tables by name, each read (and its stored form written) when it is first asked for."""

    def __init__(self, names: Iterable[str], table: Callable[[str], DataFrame]):
        self._names, self._table = list(names), table

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._table(name)

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


_RAW_TABLES = ["listings", "reviews", "calendar"]


def stamped(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The raw zone: the raw-shaped views written once per session as
    Parquet (the ingest step), then read back, so every query starts from
    a stored, splittable table as the transform job does.  Rows carry their
    ordinal."""
    return {t: _stamped(spark, sf, t) for t in _RAW_TABLES}


def _stamped(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """One table of the raw zone, for the queries that read no other."""
    return _memo(spark, sf, f"stamped_{table}", lambda: spark.read.parquet(_raw_table(spark, sf, table)))


#: Spark cuts files into parts of at least this many bytes, so a scan of less for every core is fewer tasks than cores.
_LEAST_SPLIT = 4 << 20


def _raw_table(spark: SparkSession, sf: str, table: str) -> str:
    """The folder of one table of the raw zone, written from the scan of its
    source; a source too small to give every core a task is dealt out round
    robin first, repeated keys too."""
    def build():
        from lodgespark.session import split_large_stages
        from lodgespark.sources.raw import write_raw_zone
        split_large_stages(spark)
        path = f"{_memo(spark, sf, 'raw_zone', lambda: _scratch(spark, 'raw-zone'))}/{table}"
        source = spark._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{FX.SOURCES[table]}.parquet")
        size = source.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(source).getLength()
        df, cores = FX.raw_tables(spark, sf)[table], spark.sparkContext.defaultParallelism
        write_raw_zone(df.repartition(cores) if size < cores * _LEAST_SPLIT else df, path)
        return path
    return _memo(spark, sf, f"raw_{table}", build)


def footers(spark: SparkSession, sf: str) -> Mapping[str, DataFrame]:
    """The raw tables' own columns, whose counts come from the file footers."""
    from lodgespark.sources.raw import read_footers
    return _PerTable(_RAW_TABLES, lambda t: read_footers(spark, _raw_table(spark, sf, t)).drop(C.ORDINAL))


def raw(spark: SparkSession, sf: str) -> Mapping[str, DataFrame]:
    """The raw tables' own columns."""
    return _PerTable(_RAW_TABLES, lambda t: _stamped(spark, sf, t).drop(C.ORDINAL))


def clean(spark: SparkSession, sf: str) -> Mapping[str, DataFrame]:
    """The transforms' results, as the transform job stores them, table by
    table (the monthly summary with the calendar)."""
    def table(name: str) -> DataFrame:
        root = _clean_zone(spark, sf, [name])
        return _memo(spark, sf, f"clean_{name}", lambda: spark.read.parquet(f"{root}/{name}_clean"))
    return _PerTable([*_RAW_TABLES, "calendar_summary"], table)


def parents(spark: SparkSession, sf: str) -> DataFrame:
    """Parent listings for reference checks."""
    return clean(spark, sf)["listings"]


# ------------------------------------------------------------------ 2.8 scalars

@query("parse_price")
def q_parse_price(spark, sf):
    return raw(spark, sf)["listings"].select("id", "price", S.parse_price("price").alias("price_clean"))


@query("parse_price_signed")
def q_parse_price_signed(spark, sf):
    return raw(spark, sf)["listings"].select("id", "price", S.parse_price_signed("price").alias("price_num"))


@query("categorize_price")
def q_categorize_price(spark, sf):
    lst = raw(spark, sf)["listings"]
    p = S.parse_price("price")
    return lst.select("id", "price", S.categorize_price(p, K.DEFAULT_Q25, K.DEFAULT_Q50, K.DEFAULT_Q75)
                      .alias("price_category"))


@query("count_list_items")
def q_count_list_items(spark, sf):
    return raw(spark, sf)["listings"].select("id", "amenities", S.count_list_items("amenities").alias("n_amenities"))


@query("parse_list")
def q_parse_list(spark, sf):
    lst = raw(spark, sf)["listings"].select("id", S.parse_list("amenities").alias("items"))
    return lst.select("id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items_text"))


@query("parse_date")
def q_parse_date(spark, sf):
    lst = raw(spark, sf)["listings"]
    return lst.select("id", F.col("host_since").alias("host_since_raw"), S.parse_date("host_since").alias("host_since"),
                      S.parse_date("last_review").alias("last_review"))


@query("date_parts_listing")
def q_date_parts_listing(spark, sf):
    return clean(spark, sf)["listings"].select("id", "host_since_year", "host_since_month", "host_since_quarter",
                                               "last_review_year")


@query("date_parts_review")
def q_date_parts_review(spark, sf):
    return clean(spark, sf)["reviews"].select("id", "year", "month", "day", "quarter", "day_of_week", "is_weekend")


@query("date_parts_calendar")
def q_date_parts_calendar(spark, sf):
    return clean(spark, sf)["calendar"].select("listing_id", "date", "year", "month", "week", "quarter",
                                               "day_of_week")


@query("format_date_iso")
def q_format_date_iso(spark, sf):
    return clean(spark, sf)["reviews"].select("id", S.format_date_iso("date").alias("date_text"))


@query("month_period")
def q_month_period(spark, sf):
    cal = raw(spark, sf)["calendar"]
    return cal.select("listing_id", "date", S.month_period(S.parse_date("date")).alias("mes"))


@query("map_flag")
def q_map_flag(spark, sf):
    lst = raw(spark, sf)["listings"]
    return lst.select("id", S.map_flag("host_is_superhost").alias("host_is_superhost"),
                      S.map_flag("instant_bookable").alias("instant_bookable"))


@query("flag_to_int")
def q_flag_to_int(spark, sf):
    cal = raw(spark, sf)["calendar"]
    return cal.select("listing_id", "date", "available", S.flag_to_int("available").alias("disp_bool"),
                      S.flag_to_int("available", unknown=0).alias("disp_num"))


@query("parse_numeric")
def q_parse_numeric(spark, sf):
    lst = raw(spark, sf)["listings"]
    cols = ["accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights", "maximum_nights",
            "review_scores_rating"]
    return lst.select("id", *[S.parse_numeric(c).alias(c) for c in cols])


@query("impute_defaults")
def q_impute_defaults(spark, sf):
    lst = raw(spark, sf)["listings"]
    return C.impute_defaults(lst).select("id", *K.LISTING_NUMERIC_DEFAULTS.keys())


@query("fill_comment")
def q_fill_comment(spark, sf):
    rev = raw(spark, sf)["reviews"]
    return rev.select("id", "listing_id", "date", S.fill_comment("comments").alias("comments"))


@query("truncate_text")
def q_truncate_text(spark, sf):
    docs = FX.read_table(spark, sf, "documents")
    t = S.truncate_text("text")
    return docs.select("doc_id", t.alias("text"), F.length(t).alias("n_chars_cut"),
                       S.display_text("text").alias("display"))


@query("round_half_even")
def q_round_half_even(spark, sf):
    li = FX.read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     S.round_half_even(F.col("l_discount") * 100 + 0.125, 2).alias("r2"),
                     S.round_half_even(F.col("l_tax") * 10 + 0.25, 1).alias("r1"))


@query("parse_percent")
def q_parse_percent(spark, sf):
    lst = raw(spark, sf)["listings"]
    return lst.select("id", "host_response_rate", S.parse_percent("host_response_rate").alias("response_rate"))


@query("null_tokens")
def q_null_tokens(spark, sf):
    lst = raw(spark, sf)["listings"]
    return C.normalize_null_tokens(lst)


# ------------------------------------------------------------------ helpers over the raw listings

def listings_numeric(spark, sf) -> DataFrame:
    """Raw listings (as extracted, repeated rows included) with the numeric
    columns parsed the way the analysis does: price without '$' and ',',
    numerics coerced, list size of amenities."""
    def build():
        lst = raw(spark, sf)["listings"]
        nums = {c: S.parse_numeric(c) for c in K.DESCRIBE_COLUMNS if c in lst.columns}
        nums["price_num"] = S.parse_price_signed("price")
        nums["n_amenities"] = F.size(S.parse_list("amenities"))
        return lst.withColumns(nums)
    return _memo(spark, sf, "listings_numeric", build)


def reviews_dated(spark, sf) -> DataFrame:
    return _memo(spark, sf, "reviews_dated",
                 lambda: raw(spark, sf)["reviews"].withColumn("date", S.parse_date("date")))


# ------------------------------------------------------------------ 2.2 projections and filters

@query("select_existing")
def q_select_existing(spark, sf):
    return C.select_existing(raw(spark, sf)["listings"], ["id", "name", "price", "latitude", "room_type", "longitude"])


@query("rename_columns")
def q_rename_columns(spark, sf):
    lst = C.select_existing(clean(spark, sf)["listings"], ["id", "price_clean", "neighbourhood_cleansed"])
    return C.rename_columns(lst, {"price_clean": "price", "neighbourhood_cleansed": "barrio", "absent": "x"})


@query("drop_known_sparse")
def q_drop_known_sparse(spark, sf):
    return C.drop_known_sparse(raw(spark, sf)["listings"])


@query("drop_sparse_columns")
def q_drop_sparse_columns(spark, sf):
    return C.drop_sparse_columns(raw(spark, sf)["listings"], 0.95)


@query("filter_non_null")
def q_filter_non_null(spark, sf):
    return C.filter_non_null(clean(spark, sf)["listings"], "review_scores_rating").select("id", "review_scores_rating")


@query("filter_upper_percentile")
def q_filter_upper_percentile(spark, sf):
    return C.filter_upper_percentile(listings_numeric(spark, sf), "price_num", 0.99).select("id", "price_num")


@query("filter_year_from")
def q_filter_year_from(spark, sf):
    return C.filter_year_from(clean(spark, sf)["reviews"], "date", FIRST_YEAR).select("id", "date", "year")


@query("filter_valid_min_nights")
def q_filter_valid_min_nights(spark, sf):
    return C.filter_valid_min_nights(clean(spark, sf)["listings"]).select("id", "minimum_nights")


# ------------------------------------------------------------------ 2.3 joins

@query("semi_join_valid_parents")
def q_semi_join_valid_parents(spark, sf):
    return Q.semi_join_valid_parents(raw(spark, sf)["reviews"], parents(spark, sf))


@query("fk_orphans")
def q_fk_orphans(spark, sf):
    return Q.fk_orphans(raw(spark, sf)["reviews"], parents(spark, sf)).select("id", "listing_id")


@query("broadcast_thresholds", rounded={"q25": 6, "q50": 6, "q75": 6})
def q_broadcast_thresholds(spark, sf):
    lst = clean(spark, sf)["listings"]
    t = T.price_thresholds(lst)
    return lst.select("id", "price_clean", "price_category", t["q25"].alias("q25"), t["q50"].alias("q50"),
                      t["q75"].alias("q75"))


# ------------------------------------------------------------------ 2.4 deduplication

@query("dedup_listings")
def q_dedup_listings(spark, sf):
    return C.keep_first(_stamped(spark, sf, "listings"), ["id"]).drop(C.ORDINAL)


@query("dedup_reviews")
def q_dedup_reviews(spark, sf):
    return C.keep_first(_stamped(spark, sf, "reviews"), ["id"]).drop(C.ORDINAL)


@query("dedup_calendar")
def q_dedup_calendar(spark, sf):
    return C.keep_first(_stamped(spark, sf, "calendar"), ["listing_id", "date"]).drop(C.ORDINAL)


@query("duplicate_counts")
def q_duplicate_counts(spark, sf):
    r = raw(spark, sf)
    keys = {"listings": ["id"], "reviews": ["id"], "calendar": ["listing_id", "date"]}
    parts = [C.duplicate_count(r[t], k).select(F.lit(t).alias("table_name"), "duplicates") for t, k in keys.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------------ 2.4 summaries

@query("calendar_monthly_summary")
def q_calendar_monthly_summary(spark, sf):
    return SM.calendar_monthly_summary(clean(spark, sf)["calendar"])


@query("calendar_weekly_summary")
def q_calendar_weekly_summary(spark, sf):
    return SM.calendar_weekly_summary(clean(spark, sf)["calendar"])


@query("availability_by_month", rounded={"disponibilidad_pct": 6})
def q_availability_by_month(spark, sf):
    return SM.availability_by_month(raw(spark, sf)["calendar"])


@query("availability_crosstab")
def q_availability_crosstab(spark, sf):
    return SM.availability_crosstab(raw(spark, sf)["calendar"])


@query("availability_share")
def q_availability_share(spark, sf):
    return SM.value_share(raw(spark, sf)["calendar"], "available", keep_null=False, decimals=2)


@query("available_counts")
def q_available_counts(spark, sf):
    return SM.value_counts(raw(spark, sf)["calendar"], "available", keep_null=True)


@query("price_category_counts")
def q_price_category_counts(spark, sf):
    return SM.value_counts(clean(spark, sf)["listings"], "price_category")


@query("room_type_counts")
def q_room_type_counts(spark, sf):
    return SM.value_counts(raw(spark, sf)["listings"], "room_type", keep_null=True)


@query("room_type_share", rounded={"pct": 6})
def q_room_type_share(spark, sf):
    return SM.value_share(raw(spark, sf)["listings"], "room_type", keep_null=False, decimals=None,
                          denominator="all")


@query("top_neighbourhoods")
def q_top_neighbourhoods(spark, sf):
    return SM.value_counts(raw(spark, sf)["listings"], "neighbourhood_cleansed", keep_null=False, top=10)


@query("top_neighbourhoods_store")
def q_top_neighbourhoods_store(spark, sf):
    return SM.value_counts(raw(spark, sf)["listings"], "neighbourhood_cleansed", keep_null=True, top=5)


@query("top_reviewed_listings")
def q_top_reviewed_listings(spark, sf):
    return SM.value_counts(raw(spark, sf)["reviews"], "listing_id", keep_null=True, top=5)


@query("top_amenities")
def q_top_amenities(spark, sf):
    return SM.top_list_items(raw(spark, sf)["listings"], "amenities", 20)


@query("amenities_stats", rounded={"mean_items": 6})
def q_amenities_stats(spark, sf):
    return SM.list_size_stats(raw(spark, sf)["listings"], "amenities")


@query("reviews_per_year")
def q_reviews_per_year(spark, sf):
    return SM.rows_per_year(reviews_dated(spark, sf), "date", FIRST_YEAR)


@query("reviews_seasonality")
def q_reviews_seasonality(spark, sf):
    return SM.rows_per_calendar_month(reviews_dated(spark, sf), "date")


@query("review_date_range")
def q_review_date_range(spark, sf):
    return SM.date_range(reviews_dated(spark, sf), "date", distinct_years=True)


@query("calendar_date_range")
def q_calendar_date_range(spark, sf):
    cal = raw(spark, sf)["calendar"].withColumn("date", S.parse_date("date"))
    return SM.date_range(cal, "date")


@query("distinct_flag_values")
def q_distinct_flag_values(spark, sf):
    r = raw(spark, sf)
    lst = P.distinct_values(r["listings"], K.LISTING_FLAG_COLUMNS).withColumn("table_name", F.lit("listings"))
    cal = P.distinct_values(r["calendar"], ["available"], keep_null=["available"]).withColumn(
        "table_name", F.lit("calendar"))
    return lst.unionByName(cal)


# ------------------------------------------------------------------ 2.4 profiles

@query("null_profile", rounded={"null_pct": 6})
def q_null_profile(spark, sf):
    return P.null_profile(footers(spark, sf)["listings"], 40)


@query("null_counts")
def q_null_counts(spark, sf):
    parts = [P.null_counts(df).select(F.lit(t).alias("table_name"), "*") for t, df in footers(spark, sf).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("null_overview", rounded={"mean_null_pct": 6})
def q_null_overview(spark, sf):
    r = footers(spark, sf)
    return P.null_overview({t: r[t] for t in ["listings", "reviews", "calendar"]})


_STAT6 = {k: 6 for k in ["mean", "std", "min", "p25", "p50", "p75", "max"]}


@query("describe_numeric", rounded=_STAT6)
def q_describe_numeric(spark, sf):
    return P.describe_numeric(listings_numeric(spark, sf), K.DESCRIBE_COLUMNS)


@query("price_quartiles", rounded={"q25": 6, "q50": 6, "q75": 6, "median": 6})
def q_price_quartiles(spark, sf):
    return P.price_quartiles(clean(spark, sf)["listings"], "price_clean")


_IQR6 = {k: 6 for k in ["q1", "q3", "iqr", "lower_bound", "upper_bound", "pct_outliers", "mean", "median"]}


@query("iqr_outliers", rounded=_IQR6)
def q_iqr_outliers(spark, sf):
    return P.iqr_outliers(listings_numeric(spark, sf), K.OUTLIER_COLUMNS)


@query("boxplot_stats", rounded={k: 6 for k in ["q1", "median", "q3", "whisker_low", "whisker_high"]})
def q_boxplot_stats(spark, sf):
    return P.boxplot_stats(listings_numeric(spark, sf), K.OUTLIER_COLUMNS)


@query("price_outlier_flag")
def q_price_outlier_flag(spark, sf):
    return P.outlier_flag(clean(spark, sf)["listings"], "price_clean", 3.0).select("id", "price_clean", "price_outlier")


_HIST6 = {"lower": 6, "upper": 6}


@query("histogram_price", rounded=_HIST6)
def q_histogram_price(spark, sf):
    return P.histogram(listings_numeric(spark, sf), "price_num", 60, upper_quantile=0.99)


@query("histogram_availability", rounded={**_HIST6, "median": 6})
def q_histogram_availability(spark, sf):
    lst = listings_numeric(spark, sf)
    med = exact_quantiles(lst, "availability_365", [0.5]).scalar()
    return P.histogram(lst, "availability_365", 40).withColumn("median", med)


@query("histogram_amenities", rounded={**_HIST6, "mean": 6})
def q_histogram_amenities(spark, sf):
    lst = listings_numeric(spark, sf)
    mean = lst.agg(F.avg("n_amenities").alias("m")).scalar()
    return P.histogram(lst, "n_amenities", 30).withColumn("mean", mean)


@query("correlation_matrix", rounded={"corr": 6})
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(listings_numeric(spark, sf), K.CORRELATION_COLUMNS)


@query("correlation_with_price", rounded={"corr": 6})
def q_correlation_with_price(spark, sf):
    return P.correlation_with(listings_numeric(spark, sf), "price_num", K.CORRELATION_COLUMNS)


@query("neighbourhood_median_impute")
def q_neighbourhood_median_impute(spark, sf):
    lst = clean(spark, sf)["listings"]
    return C.neighbourhood_median_impute(lst).select("id", "neighbourhood_cleansed", "price_clean", "price_imputed")


# ------------------------------------------------------------------ 2.6 samples

@query("sample_rows")
def q_sample_rows(spark, sf):
    lst = clean(spark, sf)["listings"]
    return lst.orderBy(F.col("id").asc_nulls_last()).limit(5).select("id", "name", "price_clean", "room_type")


@query("format_samples")
def q_format_samples(spark, sf):
    lst = raw(spark, sf)["listings"]
    wanted = [(c, 3) for c in K.FORMAT_SAMPLE_DATE_COLUMNS if c in lst.columns] + [("price", 5)]
    parts = []
    for c, n in wanted:
        parts.append(lst.filter(F.col(c).isNotNull()).orderBy(F.col("id").asc(), F.col(c).asc()).limit(n)
                     .select(F.lit(c).alias("column"), F.col("id"), F.col(c).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ 2.13 pipelines

@query("transform_listings")
def q_transform_listings(spark, sf):
    return T.transform_listings(_stamped(spark, sf, "listings"))


@query("transform_reviews")
def q_transform_reviews(spark, sf):
    return T.transform_reviews(_stamped(spark, sf, "reviews"))


@query("transform_calendar")
def q_transform_calendar(spark, sf):
    return T.transform_calendar(_stamped(spark, sf, "calendar"))


@query("transform_all")
def q_transform_all(spark, sf):
    """Rows and columns of every transformed table, and per column what its
    values come to: their count and the sum of their lengths as text."""
    out = T.transform_all(stamped(spark, sf))
    parts = [_contents(df).select(F.lit(n).alias("table_name"), "*") for n, df in out.items()]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


# ------------------------------------------------------------------ 2.11 constraints

_RAW_KEYS = {"listings": ["id"], "reviews": ["id"], "calendar": ["listing_id", "date"]}


@query("check_unique")
def q_check_unique(spark, sf):
    r = raw(spark, sf)
    parts = [Q.check_unique(r[t], k).select(F.lit(t).alias("table_name"),
                                           F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("<null>")) for c in k]).alias("key_value"),
                                           "rows")
             for t, k in _RAW_KEYS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("check_not_null")
def q_check_not_null(spark, sf):
    from lodgespark.sources import zones as Z
    c = clean(spark, sf)
    parts = []
    for t in ["reviews", "calendar", "calendar_summary"]:
        serving = Z.SERVING_PROJECTIONS[t](c[t])
        parts.append(Q.check_not_null(serving, Z.SERVING_NOT_NULL[t]).withColumn("table_name", F.lit(t)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("check_types")
def q_check_types(spark, sf):
    from lodgespark.sources import zones as Z
    parts = [Q.check_types(df, Z.SERVING_SCHEMAS[t]).select(F.lit(t).alias("table_name"), "*") for t, df in raw(spark, sf).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("quality_report")
def q_quality_report(spark, sf):
    """Every rule of the serving tables against the raw tables (and the summary)."""
    from lodgespark.sources import zones as Z
    r = {**raw(spark, sf), "calendar_summary": clean(spark, sf)["calendar_summary"]}
    parts = [Q.quality_report(t, r[t], keys=Z.SERVING_KEYS[t], not_null=Z.SERVING_NOT_NULL[t], schema=Z.SERVING_SCHEMAS[t],
                              parents={"listing_id": (r["listings"], "id")} if "listing_id" in r[t].columns else None)
             for t in Z.PUBLISH_ORDER]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ------------------------------------------------------------------ 2.12 run metrics

@query("run_metrics", rounded={"value": 6})
def q_run_metrics(spark, sf):
    """Metrics of a transform-job run, gathered while the clean zone is written."""
    from lodgespark.plans.jobs import transform_job_metrics
    m = transform_job_metrics(stamped(spark, sf), _scratch(spark, "clean-zone"))
    return m.withColumnRenamed("table", "table_name")


@query("run_log", rounded={"value": 6})
def q_run_log(spark, sf):
    """One run of all three jobs, from CSV files to the serving zone, as its log tells it."""
    from lodgespark.operators import metrics as M
    from lodgespark.plans import jobs as J
    from lodgespark.sources import raw as R
    root = _scratch(spark, "run-log")

    def landing():
        path = _scratch(spark, "landing")
        for t, df in stamped(spark, sf).items():  # files in the rows' order, as the first occurrence stays
            R.write_csv_gz(df.orderBy(C.ORDINAL).drop(C.ORDINAL), f"{path}/{t}")
        return path
    source = _memo(spark, sf, "landing_csv", landing)
    report = J.ingest_job(spark, {t: (f"{source}/{t}", None) for t in FX.raw_tables(spark, sf)}, f"{root}/raw", keep=1).collect()
    M.append_run_log(spark, f"{root}/log", "run-1", "ingest", M.ingest_records(report))
    ingested = {t: R.read_raw_zone(spark, f"{root}/raw/{t}")[0] for t in FX.raw_tables(spark, sf)}
    records = J.refresh_clean_zone(spark, ingested, f"{root}/clean", keep=1)[1]
    M.append_run_log(spark, f"{root}/log", "run-1", "transform", records)
    report = J.refresh_serving_zone(spark, f"{root}/clean", f"{root}/serving", "quarantine", keep=1)
    M.append_run_log(spark, f"{root}/log", "run-1", "publish", M.publish_records(report))
    return M.read_run_log(spark, f"{root}/log").select("stage", F.col("table").alias("table_name"), "metric", "value")


# ------------------------------------------------------------------ 2.1 sources and sinks

def _scratch(spark, name):
    from lodgespark.session import scratch_path
    return scratch_path(spark, name)


def raw_zone_catalog(spark, sf) -> dict[str, DataFrame]:
    """The raw zone (Parquet), so that extracts show predicate and column
    pushdown into the scan."""
    return raw(spark, sf)


@query("scan_raw_csv")
def q_scan_raw_csv(spark, sf):
    from lodgespark.sources import raw as R
    rev = raw(spark, sf)["reviews"]

    def landing():
        # the landing file (gzip CSV) is written once per session and input
        path = _scratch(spark, "raw-csv") + "/reviews"
        R.write_csv_gz(rev, path)
        return path
    path = _memo(spark, sf, "landing_reviews_csv", landing)
    return R.scan_raw_csv(spark, path, rev.columns, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("write_raw_zone")
def q_write_raw_zone(spark, sf):
    from lodgespark.sources import raw as R
    path = _scratch(spark, "raw-zone") + "/listings"
    R.write_raw_zone(C.normalize_null_tokens(raw(spark, sf)["listings"]), path)
    return spark.read.parquet(path)


@query("quarantine_bad_rows")
def q_quarantine_bad_rows(spark, sf):
    """Reviews written as CSV text lines without a header: comments are quoted
    and hold a line break, every id divisible by 13 has a field too many and
    every other id divisible by 17 two too few.  The rows are stored once,
    then read back from both halves."""
    from lodgespark.sources import raw as R
    rev = raw(spark, sf)["reviews"]
    number = F.col("id").cast("long")
    value = {c: F.coalesce(F.col(c), F.lit("")) for c in rev.columns}
    value["comments"] = F.concat(F.lit('"'), value["comments"], F.lit('\nend"'))
    short = F.concat_ws(",", *[value[c] for c in rev.columns[:-2]])
    line = F.concat_ws(",", *[value[c] for c in rev.columns])
    line = F.when(number % 13 == 0, F.concat(line, F.lit(",extra"))).when(number % 17 == 0, short).otherwise(line)

    def stored():
        path = _scratch(spark, "quarantine")
        rev.select(line.alias("value")).write.mode("overwrite").text(f"{path}/landing")
        R.write_flagged(R.scan_flagged(spark, f"{path}/landing", rev.columns, header=False), f"{path}/raw")
        return f"{path}/raw"
    good, bad = R.read_raw_zone(spark, _memo(spark, sf, "flagged_reviews", stored))
    wanted = ["id", "listing_id", "comments"]
    return good.select(*wanted, F.lit(False).alias("rejected")).unionByName(
        bad.select("id", "listing_id", F.lit(None).cast("string").alias("comments"), F.lit(True).alias("rejected")))


def _extract_cat(spark, sf):
    return raw_zone_catalog(spark, sf)


@query("extract_filter_project_limit")
def q_extract_filter_project_limit(spark, sf):
    from lodgespark.sources import raw as R
    cat = _extract_cat(spark, sf)
    return R.extract(cat, "calendar", where={"available": None, "date": {"$ne": "bad"}}, columns=["listing_id", "date", "available"],
                     limit=500, order_by=["listing_id", "date"])


@query("extract_listings")
def q_extract_listings(spark, sf):
    from lodgespark.sources import raw as R
    return R.extract_listings(_extract_cat(spark, sf), where={"room_type": "SMALL"},
                              columns=["id", "price", "room_type"])


@query("extract_reviews")
def q_extract_reviews(spark, sf):
    from lodgespark.sources import raw as R
    return R.extract_reviews(_extract_cat(spark, sf), where={"date": {"$gte": "1998-01-01"}},
                             columns=["id", "listing_id", "date"])


@query("extract_calendar")
def q_extract_calendar(spark, sf):
    from lodgespark.sources import raw as R
    return R.extract_calendar(_extract_cat(spark, sf), where={"available": "f"})


@query("extract_all_summary")
def q_extract_all_summary(spark, sf):
    from lodgespark.sources import raw as R
    return R.extract_all_summary(_extract_cat(spark, sf))


@query("table_profile")
def q_table_profile(spark, sf):
    from lodgespark.sources import raw as R
    cat = footers(spark, sf)
    return R.table_profile(cat, "listings").unionByName(R.table_profile(cat, "reviews")).unionByName(
        R.table_profile(cat, "calendar"))


@query("write_clean_zone")
def q_write_clean_zone(spark, sf):
    from lodgespark.plans.jobs import read_clean, transform_job
    root = _scratch(spark, "clean-zone")
    transform_job(stamped(spark, sf), root)
    parts = [_contents(df).select(F.lit(n).alias("table_name"), "*") for n, df in read_clean(spark, root).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("read_clean_zone")
def q_read_clean_zone(spark, sf):
    from lodgespark.sources import zones as Z
    return Z.read_clean_zone(spark, _clean_zone(spark, sf, ["listings"]), ["listings"])["listings"]


@query("publish_listings")
def q_publish_listings(spark, sf):
    return _published(spark, sf, "listings")


@query("publish_reviews")
def q_publish_reviews(spark, sf):
    return _published(spark, sf, "reviews")


@query("publish_calendar")
def q_publish_calendar(spark, sf):
    return _published(spark, sf, "calendar")


@query("publish_calendar_summary")
def q_publish_calendar_summary(spark, sf):
    return _published(spark, sf, "calendar_summary")


def _published(spark, sf, table: str) -> DataFrame:
    """Publish one table from the clean zone (projection, every rule, write), as often as it is asked for."""
    from lodgespark.plans.jobs import publish_job
    root = _scratch(spark, "serving")
    # the listings are the parents of reviews and calendar
    needed = [table, "listings"] if table in ("reviews", "calendar") else [table]
    publish_job(spark, _clean_zone(spark, sf, needed), root, policy="quarantine", tables=[table])
    return spark.read.parquet(f"{root}/{table}")


def _contents(df: DataFrame) -> DataFrame:
    """(rows, column, n, length) per column: values that are not null and the
    sum of their lengths as text (of numbers: the sum of them, in thousandths)."""
    kinds = dict(df.dtypes)
    number = lambda c: F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)
    total = lambda c: (F.sum(F.length(F.col(c).cast("string"))) if kinds[c] in ("string", "date")
                       else F.sum(F.floor(number(c) * 1000 + 0.5).cast("long"))).cast("bigint")
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
                 *[total(c).alias(f"t{i}") for i, c in enumerate(df.columns)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"t{i}").alias("total")) for i, c in enumerate(df.columns)]
    return row.select("rows", F.inline(F.array(*items)))


def _clean_zone(spark, sf, tables: Iterable[str] = tuple(_RAW_TABLES)) -> str:
    """The folder of the clean zone with at least these tables, each written
    once per session and input (the publish queries start from it, as the load
    job does).  Tables that are asked for together are one run of the job."""
    from lodgespark.plans.jobs import transform_job
    root = _memo(spark, sf, "clean_zone", lambda: _scratch(spark, "clean-zone"))
    done = _memo(spark, sf, "clean_tables", set)
    wanted = {"calendar" if t == "calendar_summary" else t for t in tables}
    missing = [t for t in _RAW_TABLES if t in wanted - done]
    if missing:
        transform_job({t: _stamped(spark, sf, t) for t in missing}, root)
        done.update(missing)
    return root


def _serving_zone(spark, sf, tables: Iterable[str] | None = None) -> str:
    """The serving zone (or some of its tables), published once per session and input; rows that break a rule are put aside."""
    names = sorted(tables) if tables else None

    def build():
        from lodgespark.plans.jobs import publish_job
        root = _scratch(spark, "serving")
        publish_job(spark, _clean_zone(spark, sf, [*names, "listings"] if names else _RAW_TABLES), root, policy="quarantine", tables=names)
        return root
    return _memo(spark, sf, f"serving_zone_{'_'.join(names or ['all'])}", build)


@query("publish_all")
def q_publish_all(spark, sf):
    """Publish from the clean zone: rows per table and outcome."""
    from lodgespark.plans.jobs import publish_job
    return publish_job(spark, _clean_zone(spark, sf), _scratch(spark, "serving"), policy="quarantine")


@query("post_load_counts")
def q_post_load_counts(spark, sf):
    """Rows of the published tables against the clean rows less those put aside."""
    from lodgespark.sources import zones as Z
    root, out = _serving_zone(spark, sf), {}
    for t, df in clean(spark, sf).items():
        aside = f"{root}/_quarantine/{t}"
        p = spark._jvm.org.apache.hadoop.fs.Path(aside)
        there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
        out[t] = df.count() - (spark.read.parquet(aside).count() if there else 0)
    return Z.post_load_counts(spark, root, out)


@query("layout_by_keys")
def q_layout_by_keys(spark, sf):
    from lodgespark.sources import zones as Z
    path = _scratch(spark, "layout") + "/calendar"
    Z.layout_by_keys(spark.read.parquet(f"{_serving_zone(spark, sf, ['calendar'])}/calendar"), path, ["listing_id", "date"],
                     partition_by=["year", "month"])
    return spark.read.parquet(path)


@query("layout_access_paths")
def q_layout_access_paths(spark, sf):
    """Every clean table in its layout, and what a lookup by each access path finds there."""
    from lodgespark.sources import zones as Z
    root, out = _scratch(spark, "layouts"), None
    for table, probes in K.ACCESS_PROBES.items():
        Z.layout_table(clean(spark, sf)[table], f"{root}/{table}", table)
        for path, where in probes:
            found = spark.read.parquet(f"{root}/{table}").where(where)
            found = found.agg(F.count(F.lit(1)).alias("rows"), F.min(F.col("id" if table != "calendar" else "listing_id").cast("string")).alias("least"))
            found = found.select(F.lit(table).alias("table_name"), F.lit(path).alias("access_path"), "rows", "least")
            out = found if out is None else out.unionByName(found)
    return out


@query("export_listings")
def q_export_listings(spark, sf):
    from lodgespark.sources import zones as Z
    return Z.export_listings(clean(spark, sf)["listings"])


@query("export_calendar")
def q_export_calendar(spark, sf):
    from lodgespark.sources import zones as Z
    return Z.export_calendar(clean(spark, sf)["calendar_summary"])


@query("export_report_bundle")
def q_export_report_bundle(spark, sf):
    """Contents of the three extracts."""
    from lodgespark.sources import zones as Z
    out = Z.export_report_bundle(clean(spark, sf))
    parts = [_contents(df).select(F.lit(n).alias("table_name"), "*") for n, df in out.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
