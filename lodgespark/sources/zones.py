"""Clean and serving zones: typed projections, Parquet publish, JDBC sink,
key layout and bounded exports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType)

from lodgespark import constants as K
from lodgespark.functions import scalars as S
from lodgespark.operators.cleaning import select_existing
from lodgespark.operators.quality import type_violation
from lodgespark.sources.versions import current

# --- fixed values: declared types, keys and NOT NULL columns of the serving tables ---
SERVING_SCHEMAS = {
    "listings": StructType([
        StructField("id", LongType()), StructField("name", StringType()), StructField("host_id", LongType()),
        StructField("host_name", StringType()), StructField("host_since", DateType()),
        StructField("host_is_superhost", IntegerType()), StructField("neighbourhood_cleansed", StringType()),
        StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
        StructField("property_type", StringType()), StructField("room_type", StringType()),
        StructField("accommodates", IntegerType()), StructField("bathrooms", DoubleType()),
        StructField("bedrooms", IntegerType()), StructField("beds", IntegerType()), StructField("price", DoubleType()),
        StructField("price_category", StringType()), StructField("minimum_nights", IntegerType()),
        StructField("maximum_nights", IntegerType()), StructField("availability_365", IntegerType()),
        StructField("number_of_reviews", IntegerType()), StructField("review_scores_rating", DoubleType()),
        StructField("n_amenities", IntegerType()), StructField("host_since_year", IntegerType())]),
    "reviews": StructType([
        StructField("id", LongType()), StructField("listing_id", LongType(), False), StructField("date", DateType()),
        StructField("reviewer_id", LongType()), StructField("reviewer_name", StringType()),
        StructField("comments", StringType()), StructField("year", IntegerType()), StructField("month", IntegerType()),
        StructField("day", IntegerType()), StructField("quarter", IntegerType()),
        StructField("is_weekend", IntegerType())]),
    "calendar": StructType([
        StructField("listing_id", LongType(), False), StructField("date", DateType(), False),
        StructField("is_available", IntegerType()), StructField("minimum_nights", IntegerType()),
        StructField("maximum_nights", IntegerType()), StructField("year", IntegerType()),
        StructField("month", IntegerType()), StructField("week", IntegerType()), StructField("quarter", IntegerType()),
        StructField("day_of_week", IntegerType())]),
    "calendar_summary": StructType([
        StructField("year", IntegerType(), False), StructField("month", IntegerType(), False),
        StructField("total_dias", LongType()), StructField("dias_disponibles", LongType()),
        StructField("disponibilidad_pct", DoubleType()), StructField("noches_minimas_prom", DoubleType())]),
}
SERVING_KEYS = {"listings": ["id"], "reviews": ["id"], "calendar": ["listing_id", "date"],
                "calendar_summary": ["year", "month"]}
SERVING_NOT_NULL = {"listings": [], "reviews": ["listing_id"], "calendar": ["listing_id", "date"],
                    "calendar_summary": ["year", "month"]}
PUBLISH_ORDER = ["listings", "reviews", "calendar", "calendar_summary"]  # parents before children


def _in_schema(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name) for f in schema.fields if f.name in df.columns])


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Serving types for rows that fit them (see ``quality.first_violation``);
    a value that does not fit is an error here, never another value."""
    def cast(f: StructField) -> Column:
        c = F.col(f.name)
        ok = c.isNull() | ~type_violation(f.name, f.dataType)
        return F.when(ok, c.try_cast(f.dataType)).otherwise(F.raise_error(F.lit(f"{f.name}: value does not fit {f.dataType.simpleString()}")))
    return df.select(*[(cast(f) if df.schema[f.name].dataType != f.dataType else F.col(f.name)).alias(f.name)
                       for f in schema.fields if f.name in df.columns])


def serving_listings(clean: DataFrame) -> DataFrame:
    """24-column serving projection; price_clean -> price; unknown superhost -> 0."""
    df = select_existing(clean, K.SERVING_LISTINGS.keys()).withColumnsRenamed(
        {k: v for k, v in K.SERVING_LISTINGS.items() if k != v})
    if "host_is_superhost" in df.columns:
        df = df.withColumn("host_is_superhost", F.coalesce(F.col("host_is_superhost").cast("boolean"),
                                                           F.lit(False)).cast("int"))
    return _in_schema(df, SERVING_SCHEMAS["listings"])


def serving_reviews(clean: DataFrame, comment_chars: int | None = None) -> DataFrame:
    """11-column serving projection; the whole comments, unless the target
    table's column needs them cut to ``comment_chars``."""
    df = select_existing(clean, K.SERVING_REVIEWS)
    if "comments" in df.columns and comment_chars:
        df = df.withColumn("comments", S.truncate_text("comments", comment_chars))
    return _in_schema(df, SERVING_SCHEMAS["reviews"])


def serving_calendar(clean: DataFrame) -> DataFrame:
    """10-column serving projection (raw flag left out); unknown availability -> 0."""
    df = select_existing(clean, K.SERVING_CALENDAR)
    if "is_available" in df.columns:
        df = df.withColumn("is_available", F.coalesce(F.col("is_available").cast("boolean"), F.lit(False)).cast("int"))
    return _in_schema(df, SERVING_SCHEMAS["calendar"])


def serving_calendar_summary(summary: DataFrame) -> DataFrame:
    return _in_schema(summary, SERVING_SCHEMAS["calendar_summary"])


SERVING_PROJECTIONS = {"listings": serving_listings, "reviews": serving_reviews, "calendar": serving_calendar,
                       "calendar_summary": serving_calendar_summary}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] | None = None,
                mode: str = "overwrite") -> Observation:
    """Write one table; the row count is observed during the write (no
    second pass) and returned as an Observation."""
    obs = Observation()
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return obs


def read_clean_zone(spark: SparkSession, root: str, names: Iterable[str], limit: int | None = None,
                    schemas: Mapping[str, StructType] | None = None) -> dict[str, DataFrame]:
    """Read clean tables back (optionally with declared schemas, and the first
    ``limit`` rows in key order)."""
    out, root = {}, current(spark, root)
    for n in names:
        r = spark.read
        if schemas and n in schemas:
            r = r.schema(schemas[n])
        df = r.parquet(f"{root}/{n}_clean")
        if limit:
            df = df.orderBy(*[F.col(c).asc_nulls_last() for c in df.columns[:1]]).limit(limit)
        out[n] = df
    return out


def publish_all(frames: Mapping[str, DataFrame], root: str, jdbc: Mapping[str, str] | None = None,
                partition_by: Mapping[str, list[str]] | None = None) -> dict[str, int]:
    """Overwrite the serving tables with ``frames`` (serving projections of
    checked rows); returns rows per table.  The Parquet tables do not depend
    on each other, so their writes run as concurrent jobs.  With ``jdbc``
    ({'url': ..., plus options}) each table is then also written through JDBC
    by the executors in parallel, parents before children, as the target's
    foreign keys require."""
    names = [n for n in PUBLISH_ORDER if n in frames]
    ready = {n: typed(frames[n], SERVING_SCHEMAS[n]) for n in names}

    def write_one(name: str) -> int:
        return int(write_table(ready[name], f"{root}/{name}", partition_by=(partition_by or {}).get(name)).get["rows"])

    with ThreadPoolExecutor(max_workers=max(len(names), 1)) as pool:
        out = dict(zip(names, pool.map(write_one, names)))
    if jdbc:
        for name in names:
            jdbc_sink(ready[name], jdbc["url"], name, properties={k: v for k, v in jdbc.items() if k != "url"})
    return out


def jdbc_sink(df: DataFrame, url: str, table: str, mode: str = "overwrite", batchsize: int = 2000,
              num_partitions: int | None = None, properties: Mapping[str, str] | None = None) -> None:
    """Batched load into a relational database; every executor writes its
    partitions in parallel (``numPartitions`` caps the open connections).  The
    default empties the table first (``truncate`` keeps its definition), so a
    second run leaves the same rows; a retried task may still repeat its own
    batch where the target has no key to refuse it."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batchsize).option("truncate", True))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def post_load_counts(spark: SparkSession, root: str, expected: Mapping[str, int]) -> DataFrame:
    """Count every written table (Parquet answers from file footers) and
    compare with the rows sent; an empty table or a short load fails."""
    parts = []
    for name, n in expected.items():
        loaded = spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).cast("bigint").alias("loaded_rows"))
        parts.append(loaded.select(F.lit(name).alias("table_name"), F.lit(int(n)).cast("bigint").alias("source_rows"),
                                   "loaded_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ok = (F.col("loaded_rows") == F.col("source_rows")) & (F.col("loaded_rows") > 0)
    return out.withColumn("status", F.when(ok, F.lit("OK")).otherwise(F.lit("FALLO")))


def layout_by_keys(df: DataFrame, path: str, sort_keys: list[str], partition_by: list[str] | None = None,
                   partitions: int | None = None) -> None:
    """File layout in place of secondary indexes: range-partition and sort on
    the keys so Parquet min/max statistics skip row groups, and partition the
    folders by date parts for partition pruning.  The folder columns lead the
    range key, so each task covers a contiguous run of folders and writes a
    few files, not one file in every folder."""
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    keys = list(partition_by or []) + [k for k in sort_keys if k not in (partition_by or [])]
    laid = df.repartitionByRange(int(n), *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    w = laid.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: Bits of each coordinate in a place's key, and the masks that spread them to every second bit.
_PLACE_BITS = 31
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def place_key(latitude: str, longitude: str) -> Column:
    """Place of a point on the Z-order curve: the bits of its two coordinates in turn (null without both).

    Neighbours on the curve are near each other, so files sorted by it have
    narrow ranges of either coordinate.
    """
    def spread(c: str, half: float) -> Column:
        share = (S.parse_numeric(c) + half) / (2 * half)
        x = F.least(F.greatest(F.floor(share * float(1 << _PLACE_BITS)).cast("long"), F.lit(0)), F.lit((1 << _PLACE_BITS) - 1))
        for shift, mask in _SPREAD:
            x = x.bitwiseOR(F.call_function("shiftleft", x, F.lit(shift))).bitwiseAND(F.lit(mask))
        return x
    both = S.parse_numeric(latitude).isNotNull() & S.parse_numeric(longitude).isNotNull()
    return F.when(both, spread(longitude, 180.0).bitwiseOR(F.call_function("shiftleft", spread(latitude, 90.0), F.lit(1))))


#: One layout per table for all of its access paths.  `place`: sorted along the Z-order curve of two coordinates, which
#: serves boxes and what goes with the place; `sort`: sort keys, read by min/max statistics; `folders`: pruned by path;
#: `bloom`: columns of many values that are looked up by equality.  Columns of few values need none: their row groups
#: are skipped by their dictionaries.
LAYOUTS: dict[str, dict] = {
    "listings": {"place": ("latitude", "longitude"), "sort": ["id"], "bloom": ["id", "host_id"]},
    "reviews": {"folders": ["year", "month"], "sort": ["listing_id", "date"], "bloom": ["id"]},
    "calendar": {"folders": ["year", "month"], "sort": ["listing_id", "date"], "bloom": []},
}


def layout_table(df: DataFrame, path: str, table: str, partitions: int | None = None, row_group_bytes: int | None = None,
                 bloom_bytes: int | None = None) -> None:
    """Write a table so that each of its access paths reads a few row groups (see ``LAYOUTS``); rows and columns as they are.

    One range exchange; the sort keys break ties of the place, so points that
    repeat spread over ranges.  A bloom filter takes ``bloom_bytes`` at most in
    a row group (Parquet's default: 1 MB).
    """
    spec = LAYOUTS[table]
    folders = [c for c in spec.get("folders", []) if c in df.columns]
    n = int(partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in folders]
    if "place" in spec and all(c in df.columns for c in spec["place"]):
        keys.append(place_key(*spec["place"]))
    keys += [F.col(c) for c in spec["sort"] if c in df.columns]
    w = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite")
    for c in spec["bloom"]:
        if c in df.columns:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if bloom_bytes:
        w = w.option("parquet.bloom.filter.max.bytes", bloom_bytes)
    if folders:
        w = w.partitionBy(*folders)
    w.parquet(path)


# ------------------------------------------------------------------ exports

def export_listings(clean_listings: DataFrame) -> DataFrame:
    return select_existing(clean_listings, K.EXPORT_LISTINGS)


def export_calendar(summary: DataFrame) -> DataFrame:
    return summary.orderBy("year", "month")


def export_report_bundle(clean: Mapping[str, DataFrame], listings_rows: int | None = None,
                         reviews_rows: int | None = None) -> dict[str, DataFrame]:
    """Listings, months and reviews in key order (ids as numbers); all rows,
    or the first ``listings_rows`` / ``reviews_rows`` where a report wants so
    many (a TakeOrderedAndProject each)."""
    def in_order(df: DataFrame, n: int | None) -> DataFrame:
        out = df.orderBy(S.parse_id("id").asc_nulls_last(), F.col("id").asc_nulls_last())
        return out.limit(n) if n else out

    out = {}
    if "listings" in clean:
        out["listings"] = in_order(export_listings(clean["listings"]), listings_rows)
    if "calendar_summary" in clean:
        out["monthly"] = export_calendar(clean["calendar_summary"])
    if "reviews" in clean:
        out["reviews"] = in_order(select_existing(clean["reviews"], K.EXPORT_REVIEWS), reviews_rows)
    return out
