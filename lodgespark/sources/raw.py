"""Raw zone: read text files with every column as text, keep bad rows apart,
write the raw zone, and extract from it with pushed-down predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from lodgespark.operators.cleaning import ORDINAL, normalize_null_tokens
from lodgespark.sources.versions import current

CORRUPT_COLUMN = "_corrupt_record"
# Parquet leaves out a column chunk's statistics, its null count too, where the
# least and greatest values are long texts; cut to this length they are always kept.
STATISTICS = {"parquet.statistics.truncate.length": "64"}


def all_text_schema(columns: Iterable[str], corrupt: bool = False) -> StructType:
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt:
        fields.append(StructField(CORRUPT_COLUMN, StringType(), True))
    return StructType(fields)


def stamp_ordinal(df: DataFrame) -> DataFrame:
    """A scan with the place of every row in its source: (file, block, row in
    the scanned part), to be stamped before anything moves rows.  Within a
    file it ascends in file order; files follow their names."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.withColumn(ORDINAL, place)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the header line (of the first file, if there are several)."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path).columns)


def scan_flagged(spark: SparkSession, path: str, columns: Iterable[str], multiline: bool = True, header: bool = True,
                 null_tokens: bool = True) -> DataFrame:
    """All rows of (gzip) CSV files, every column as text, stamped with their
    ordinal and with ``rejected`` and ``_corrupt_record``.

    Columns are bound by the header's names: they may come in any order,
    columns the files lack are null, further ones are left out; files whose
    headers differ from the first one's end the run.  A row with too few or
    too many fields is ``rejected`` and keeps its text.  All fields are parsed
    whatever columns are asked for, so the flag does not depend on the query.
    """
    wanted = list(columns)
    names = csv_header(spark, path) if header else wanted
    df = (spark.read.schema(all_text_schema(names, corrupt=True)).option("header", header).option("enforceSchema", not header)
          .option("multiLine", multiline).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
          .option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).csv(path))
    df = stamp_ordinal(df)
    # the flag names a data column too: Spark refuses to read the corrupt text alone
    some = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) < 0
    df = df.withColumn("rejected", F.col(CORRUPT_COLUMN).isNotNull() | some)
    out = df.select(*[F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in wanted],
                    CORRUPT_COLUMN, "rejected", ORDINAL)
    return normalize_null_tokens(out, wanted) if null_tokens else out


def scan_raw_csv(spark: SparkSession, path: str, columns: Iterable[str], partitions: int | None = None,
                 null_tokens: bool = True, multiline: bool = True, ordinal: bool = False) -> DataFrame:
    """The well-formed rows, every column as text; quoted fields may hold
    newlines and doubled quotes.  A gzip or multi-line file is one task per
    file, so ``partitions`` spreads the rows (round robin, repeated rows too)
    before the heavy work; ``ordinal`` keeps their place in the files."""
    df = split_quarantine(scan_flagged(spark, path, columns, multiline, null_tokens=null_tokens))[0]
    df = df if ordinal else df.drop(ORDINAL)
    return df.repartition(partitions) if partitions else df


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, rejected rows with their text and parsed columns)."""
    good = df.filter(~F.col("rejected")).drop(CORRUPT_COLUMN, "rejected")
    return good, df.filter(F.col("rejected")).drop("rejected")


def write_csv_gz(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("compression", "gzip")
       .option("quote", '"').option("escape", '"').csv(path))


def write_raw_zone(df: DataFrame, path: str) -> None:
    """Idempotent full refresh of one raw table (overwrite)."""
    df.write.mode("overwrite").options(**STATISTICS).parquet(path)


def write_flagged(df: DataFrame, path: str, partitions: int | None = None) -> tuple[int, int]:
    """Store the rows of ``scan_flagged`` once, the rejected ones in a folder
    of their own; returns (well-formed, rejected) as counted by the write."""
    from pyspark.sql import Observation
    obs = Observation()
    seen = (df.repartition(partitions) if partitions else df).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("rejected"), 1)).alias("bad"))
    seen.write.mode("overwrite").partitionBy("rejected").options(**STATISTICS).parquet(path)
    n = obs.get
    return int(n["rows"] - n["bad"]), int(n["bad"])


def read_raw_zone(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(well-formed, rejected) of a table stored by ``write_flagged``."""
    path = current(spark, path)
    return split_quarantine(spark.read.parquet(path).withColumn("rejected", F.col("rejected").cast("boolean")))


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table through Spark's second Parquet reader, which answers
    counts of rows and of values per column (and bounds of numbers and dates)
    from the file footers: profiles of nulls and rows then read no data pages.
    The flat columns only, as the reader scans for all if one is nested.  For
    tables that ``write_raw_zone`` or ``write_flagged`` stored; a footer of
    another writer may lack a null count, and the query then ends with an
    error, so read such tables with ``spark.read``."""
    path = current(spark, path)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    listed = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(listed)
    spark.conf.set(listed, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(listed, before)
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (StructType, ArrayType, MapType))])


# ------------------------------------------------------------------ extract

def _predicate(where) -> Column | None:
    """A Column, a SQL string, or a document-store style dict:
    ``{"col": value}`` (equality) or ``{"col": {"$gte": v, "$lt": w, ...}}``.
    As in a document store, None matches missing values, and ``$ne`` and
    ``$nin`` keep the rows without a value."""
    if where is None or isinstance(where, Column):
        return where
    if isinstance(where, str):
        return F.expr(where)
    def one(c: Column, op: str, v) -> Column:
        if op == "$eq":
            return c.eqNullSafe(F.lit(v))
        if op == "$ne":
            return ~c.eqNullSafe(F.lit(v))
        if op in ("$in", "$nin"):
            known = [x for x in v if x is not None]
            hit = F.coalesce(c.isin(*known), F.lit(False)) if known else F.lit(False)
            hit = hit | c.isNull() if len(known) < len(list(v)) else hit
            return hit if op == "$in" else ~hit
        order = {"$gt": c > F.lit(v), "$gte": c >= F.lit(v), "$lt": c < F.lit(v), "$lte": c <= F.lit(v)}
        if op not in order:
            raise ValueError(f"unknown operator {op!r}")
        return order[op]

    pred = F.lit(True)
    for col, cond in where.items():
        for op, v in (cond.items() if isinstance(cond, Mapping) else [("$eq", cond)]):
            plain = op == "$eq" and v is not None
            pred = pred & (F.col(col) == F.lit(v) if plain else one(F.col(col), op, v))
    return pred


def extract(tables: Mapping[str, DataFrame], name: str, where=None, columns: Iterable[str] | None = None,
            limit: int | None = None, order_by: Iterable[str] | None = None) -> DataFrame:
    """Read a named table with an optional predicate, projection and limit.
    Unknown name -> ValueError; ``limit`` 0 or None -> no limit.  Predicate
    and columns reach the Parquet scan (PushedFilters / ReadSchema).  A limit
    is made repeatable by ``order_by`` (default: the table's first column)."""
    if name not in tables:
        raise ValueError(f"table '{name}' does not exist; known: {sorted(tables)}")
    df = tables[name]
    pred = _predicate(where)
    if pred is not None:
        df = df.filter(pred)
    if columns:
        df = df.select(*columns)
    if limit:
        keys = list(order_by or [df.columns[0]])
        df = df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(int(limit))
    return df


def extract_listings(tables, where=None, columns=None, limit=None) -> DataFrame:
    return extract(tables, "listings", where, columns, limit, ["id"])


def extract_reviews(tables, where=None, columns=None, limit=None) -> DataFrame:
    return extract(tables, "reviews", where, columns, limit, ["id"])


def extract_calendar(tables, where=None, columns=None, limit=None) -> DataFrame:
    return extract(tables, "calendar", where, columns, limit, ["listing_id", "date"])


def extract_all_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows, columns) per table plus a TOTAL row; the counts are
    separate aggregates unioned into one job."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
               .select(F.lit(n).alias("table_name"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.lit("TOTAL").alias("table_name"), F.sum("rows").cast("bigint").alias("rows"),
                    F.sum("columns").cast("bigint").alias("columns"))
    return out.unionByName(total)


def table_profile(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Rows, number, names and types of the fields of one table; for Parquet
    the count is answered from file footers."""
    if name not in tables:
        raise ValueError(f"table '{name}' does not exist")
    df = tables[name]
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("bigint").alias("n_fields"),
        F.lit(",".join(df.columns)).alias("fields"), F.lit(",".join(t for _, t in df.dtypes)).alias("types"))
