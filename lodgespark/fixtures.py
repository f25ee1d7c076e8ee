"""Raw-shaped views over the driver's test tables.

The test tables are typed and complete; the raw rental tables are all-text and
dirty.  These views derive listings / reviews / calendar raw tables from
``part`` and ``lineitem`` with deterministic rules that inject nulls, bad
values and junk, so every operator meets the cases it must handle.  The rules
are fixture data, not filters: every row of the source table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgespark.operators.cleaning import ORDINAL


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def listings_raw_from_part(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    size = F.col("p_size")
    hs = F.date_format(F.date_add(F.lit("2010-01-01").cast("date"), (k % 5000).cast("int")), "yyyy-MM-dd")
    price = F.format_number(F.col("p_retailprice") * (1 + k % 37), 2)
    amen = F.concat(F.lit('["'), F.replace(F.col("p_name"), F.lit(" "), F.lit('","')), F.lit('"]'))
    return part.select(
        F.when(k % 157 == 0, F.concat(F.lit("L-"), _s(k))).otherwise(_s(k)).alias("id"),
        F.col("p_name").alias("name"),
        _s(k % 100).alias("host_id"),
        F.concat(F.lit("host "), _s(k % 100)).alias("host_name"),
        F.when(k % 89 == 0, "bad-date").when(k % 31 == 0, F.lit(None)).when(k % 43 == 0, "2020-01-01 junk")
         .otherwise(hs).alias("host_since"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(hs).alias("last_review"),
        F.when(k % 5 == 0, "t").when(k % 5 == 4, F.lit(None)).otherwise("f").alias("host_is_superhost"),
        F.when(k % 6 == 0, "f").when(k % 6 == 5, "yes").otherwise("t").alias("instant_bookable"),
        F.when(k % 200 == 1, F.lit(None)).otherwise(F.col("p_brand")).alias("neighbourhood_cleansed"),
        F.lit(None).cast("string").alias("neighbourhood_group_cleansed"),
        F.when(k % 50 == 0, "L-1").alias("license"),
        F.when(k % 150 == 2, F.lit(None)).otherwise(F.col("p_type")).alias("room_type"),
        _s(size % 16 + 1).alias("accommodates"),
        F.when(k % 83 == 0, "x").when(k % 71 == 0, "1.5").when(k % 7 == 0, F.lit(None)).otherwise(_s(size % 6)).alias("bedrooms"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(_s(size % 4 + 1)).alias("beds"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 2 == 0, "1.5").otherwise("1").alias("bathrooms"),
        F.when(k % 250 == 3, "1000").otherwise(_s(size % 30 + 1)).alias("minimum_nights"),
        F.when(k % 19 == 0, F.lit(None)).otherwise("365").alias("maximum_nights"),
        _s(k * 37 % 366).alias("availability_365"),
        _s(k * 13 % 41).alias("number_of_reviews"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(_s(size % 5 + 1)).alias("review_scores_rating"),
        F.when(k % 97 == 0, F.lit(None)).when(k % 101 == 0, "$0.00")
         .when(k % 61 == 0, F.concat(F.lit("$"), F.format_number(F.col("p_retailprice") * (1 + k % 37) * 500, 2)))
         .otherwise(F.concat(F.lit("$"), price)).alias("price"),
        F.when(k % 53 == 0, F.lit(None)).when(k % 59 == 0, "not json").when(k % 11 == 0, "[]")
         .when(k % 67 == 0, '["a","b"] junk').when(k % 73 == 0, "['x', ('y','z')]")
         .when(k % 79 == 0, '["a",["b",["c",{"k":[1,2]}]],null]').when(k % 103 == 0, "['x', ['y', ('z', {'k': [1, 2]})], {'a'}]")
         .when(k % 107 == 0, "['caf\\u00e9', '\\x41\\'s', [None]]").when(k % 109 == 0, '["a",["b"]] ]')
         .otherwise(amen).alias("amenities"),
        F.when(k % 13 == 0, "N/A").otherwise(F.concat(_s(k % 101), F.lit("%"))).alias("host_response_rate"),
        F.when(k % 14 == 0, "N/A").otherwise(F.concat(_s(k % 100), F.lit("%"))).alias("host_acceptance_rate"),
        F.concat(F.lit("40."), F.lpad(_s(k % 1000), 3, "0")).alias("latitude"),
        F.concat(F.lit("-3."), F.lpad(_s(k % 997), 3, "0")).alias("longitude"),
        F.concat(F.lit("type "), _s(k % 12)).alias("property_type"),
        F.when(k % 3 == 0, F.lit(None)).when(k % 47 == 0, "unknown").otherwise(hs).alias("first_review"),
        F.when(k % 29 != 0, "2024-06-15").alias("last_scraped"),
        F.when(k % 41 == 0, "2024-06-16T10:00:00").otherwise("2024-06-16").alias("calendar_last_scraped"),
        F.lit(None).cast("string").alias("calendar_updated"),
        F.when(k % 37 == 0, F.lit(None)).when(k % 4 == 0, "f").otherwise("t").alias("has_availability"),
        F.when(k % 8 == 0, "f").otherwise("t").alias("host_has_profile_pic"),
        F.when(k % 15 == 1, F.lit(None)).when(k % 10 == 0, "f").otherwise("t").alias("host_identity_verified"),
        _s(k % 31).alias("availability_30"),
        F.when(k % 3 != 0, F.concat(F.lit("0."), _s(k % 10))).alias("reviews_per_month"),
        F.when(k % 2 == 0, "2024-07-01").alias("price_quote_checkin_date"),
        F.when(k % 2 == 0, "2024-07-08").alias("price_quote_checkout_date"),
    )


def listings_raw_with_copies(listings_raw: DataFrame) -> DataFrame:
    """Listings and, after them, a repeated row (price '$1.00') for every host
    number divisible by 20, so that keeping the first occurrence keeps the
    original.  Stamped with the ordinal."""
    number = F.regexp_replace("id", "[^0-9]", "").cast("long")
    copies = listings_raw.filter(number % 20 == 0).withColumn("price", F.lit("$1.00"))
    return (listings_raw.withColumn(ORDINAL, number)
            .unionByName(copies.withColumn(ORDINAL, number + F.lit(1_000_000_000_000))))


def _placed(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("*", F.col("_metadata.row_index").alias(ORDINAL))


def reviews_raw_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Ids repeat as they do in the source; some listings are missing, unknown
    or no number; some dates are missing or followed by junk; some comments
    are long."""
    o = F.col("l_orderkey")
    return _placed(lineitem).select(
        _s(o * 10 + F.col("l_linenumber")).alias("id"),
        F.when(o % 101 == 0, F.lit(None)).when(o % 103 == 0, "999999999").when(o % 107 == 0, F.concat(F.lit("x"), _s(F.col("l_partkey"))))
         .otherwise(_s(F.col("l_partkey"))).alias("listing_id"),
        F.when(o % 113 == 0, "2020-01-01 junk").when(o % 127 == 0, F.lit(None))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        _s(F.col("l_suppkey")).alias("reviewer_id"),
        F.concat(F.lit("user "), _s(F.col("l_suppkey"))).alias("reviewer_name"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).when(o % 211 == 0, F.repeat(F.concat("l_returnflag", "l_linestatus"), F.lit(2500)))
         .otherwise(F.concat("l_returnflag", "l_linestatus")).alias("comments"),
        ORDINAL,
    )


def calendar_raw_from_lineitem(lineitem: DataFrame) -> DataFrame:
    o, q = F.col("l_orderkey"), F.col("l_quantity").cast("int")
    return _placed(lineitem).select(
        F.when(o % 109 == 0, F.lit(None)).otherwise(_s(F.col("l_partkey"))).alias("listing_id"),
        F.when(o % 131 == 0, "bad").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("l_returnflag") == "A", "t").when(F.col("l_returnflag") == "N", "f")
         .when(F.col("l_linenumber") == 3, "x").alias("available"),
        F.when(o % 137 == 0, "2.5").otherwise(_s(q)).alias("minimum_nights"),
        _s(q * 20).alias("maximum_nights"),
        ORDINAL,
    )


#: The driver's table behind each raw table.
SOURCES = {"listings": "part", "reviews": "lineitem", "calendar": "lineitem"}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw tables (listings with its repeated rows), stamped with the ordinal."""
    part = read_table(spark, sf_dir, "part")
    lineitem = read_table(spark, sf_dir, "lineitem")
    return {
        "listings": listings_raw_with_copies(listings_raw_from_part(part)),
        "reviews": reviews_raw_from_lineitem(lineitem),
        "calendar": calendar_raw_from_lineitem(lineitem),
    }
