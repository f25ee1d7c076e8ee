"""Projection, filtering, deduplication and null handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodgespark import constants as K
from lodgespark.functions import scalars as S
from lodgespark.operators.quantiles import exact_quantiles, grouped_quantiles


#: Place of a row in the source files, stamped by the scan.
ORDINAL = "_ordinal"


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist; silently skip the others."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_known_sparse(df: DataFrame, columns: Iterable[str] = K.KNOWN_SPARSE_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def normalize_null_tokens(df: DataFrame, columns: Iterable[str] | None = None, tokens=None) -> DataFrame:
    """Reader missing-value tokens -> null over string columns (one projection)."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[S.normalize_null_token(c, tokens).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, or in the order of the source
    files where the scan stamped it (``ORDINAL``, see ``sources.raw``), as
    pandas' ``drop_duplicates(keep="first")`` does.

    The result is repeatable when the order is total within a key, as the
    stamped one is.  Plan: row_number over the key with ``= 1``; Spark inserts
    a partial WindowGroupLimit before the shuffle, so a hot key sends at most
    one row per map task, never its whole group.
    """
    if not order:
        if ORDINAL not in df.columns:
            raise ValueError(f"keep_first needs an order: the table has no {ORDINAL} column from a scan")
        order = [F.col(ORDINAL).asc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Surplus rows per key (all but the first); null keys equal each other.
    One-row result: ``duplicates`` (bigint)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def filter_non_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def filter_year_from(df: DataFrame, date_col: str, first_year: int) -> DataFrame:
    """Rows whose date falls in ``first_year`` or later.  Stated on the date
    itself (not on year()) so Parquet min/max statistics can skip row groups."""
    return df.filter(F.col(date_col) >= F.lit(f"{first_year:04d}-01-01").cast("date"))


def filter_valid_min_nights(df: DataFrame, column: str = "minimum_nights", max_nights: float = 365) -> DataFrame:
    """Drop rows with more than ``max_nights`` minimum nights; null passes."""
    c = F.col(column)
    return df.filter(c.isNull() | (c <= max_nights))


def filter_upper_percentile(df: DataFrame, column: str, q: float = 0.99) -> DataFrame:
    """Keep rows at or below the exact ``q`` percentile of ``column`` (nulls
    drop out); the percentile is one row, inlined as a scalar subquery."""
    bound = exact_quantiles(df, column, [q]).scalar()
    return df.filter(F.col(column) <= bound)


def impute_defaults(df: DataFrame, defaults: Mapping[str, object] = K.LISTING_NUMERIC_DEFAULTS) -> DataFrame:
    """Parse each listed column as a number, then fill nulls with its default
    (``None`` keeps null).  Columns that are absent are skipped."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    out = df.withColumns({c: S.parse_numeric(c) for c in present})
    fills = {c: v for c, v in present.items() if v is not None}
    return out.na.fill(fills) if fills else out


SALTS = 32  # parts of every group in a salted join


def join_group_values(df: DataFrame, values: DataFrame, group_col: str, broadcast_bytes: int) -> DataFrame:
    """Left join of one row per group (``__g`` and further columns) to all rows.
    Values of at most ``broadcast_bytes`` (names and 64 bytes a group, added up
    first) are a broadcast hash join: the table's rows do not move.  Larger
    ones meet the rows by group and salt, which deals a group that holds a
    third of the rows over ``SALTS`` tasks; the salt is the row's partition,
    so a lost task computes it again alike."""
    size = values.agg(F.sum(F.octet_length(F.col("__g").cast("string")) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        return df.join(F.broadcast(values), df[group_col] == values["__g"], "left").drop("__g")
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    copies = values.withColumn("__salt_g", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = (salted[group_col] == copies["__g"]) & (salted["__salt"] == copies["__salt_g"])
    return salted.join(copies, on, "left").drop("__g", "__salt", "__salt_g")


def neighbourhood_median_impute(df: DataFrame, value_col: str = "price_clean",
                                group_col: str = "neighbourhood_cleansed",
                                out_col: str = "price_imputed",
                                replace_outliers: bool = False, k: float = 3.0, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Fill a missing (or, optionally, outlying) value with the exact median
    of its group.  The medians are one row per group: up to
    ``broadcast_bytes`` of them a broadcast join, more a salted one."""
    v = F.col(value_col)
    medians = grouped_quantiles(df.select(group_col, v.alias("x")), [group_col], [0.5]).select(
        F.col(group_col).alias("__g"), F.col("q")[0].alias("__median"))
    out = join_group_values(df, medians.filter(F.col("__g").isNotNull()), group_col, broadcast_bytes)
    bad = v.isNull()
    if replace_outliers:
        q = exact_quantiles(df, value_col, [0.25, 0.75]).select(F.array("*")).scalar()
        out = out.withColumn("__q", q)
        lo = F.col("__q")[0] - k * (F.col("__q")[1] - F.col("__q")[0])
        hi = F.col("__q")[1] + k * (F.col("__q")[1] - F.col("__q")[0])
        bad = bad | (v < lo) | (v > hi)
        out = out.withColumn(out_col, F.when(bad, F.col("__median")).otherwise(v)).drop("__q")
    else:
        out = out.withColumn(out_col, F.when(bad, F.col("__median")).otherwise(v))
    return out.drop("__median")


def sparse_columns(df: DataFrame, threshold: float = 0.95) -> list[str]:
    """Columns whose share of nulls is above ``threshold``: one aggregate over
    the table; its single row is read on the driver because it decides the
    output schema."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(F.col(c)).alias(f"n__{i}") for i, c in enumerate(df.columns)]).first()
    rows = row["__rows"]
    if not rows:
        return []
    return [c for i, c in enumerate(df.columns) if (rows - row[f"n__{i}"]) / rows > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Drop the columns with more than ``threshold`` nulls (the rule the fixed
    list of sparse columns stands for)."""
    return df.drop(*sparse_columns(df, threshold))
