"""Grouped summaries: calendar availability by month/week, value counts,
top-k, list-item counts and review time summaries.

All are ``groupBy`` aggregates: Spark computes partial aggregates in each map
task before the shuffle, so a hot key (one month, one listing) sends one
partial row per task rather than its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgespark.functions import scalars as S
from lodgespark.operators.profiling import scalar_row


def _avail_num(cal: DataFrame) -> Column:
    """0/1 availability for the summary; unknown counts as 0."""
    if "is_available" in cal.columns:
        return F.coalesce(F.col("is_available").cast("int"), F.lit(0))
    return S.flag_to_int("available", unknown=0)


def calendar_monthly_summary(cal: DataFrame) -> DataFrame:
    """By (year, month): days with a date, available days, % available (2
    decimals, half-even) and mean minimum nights (1 decimal); rows without a
    year are left out; sorted by key."""
    d = _avail_num(cal)
    return (cal.filter(F.col("year").isNotNull() & F.col("month").isNotNull())
               .groupBy("year", "month")
               .agg(F.count("date").cast("bigint").alias("total_dias"),
                    F.sum(d).cast("bigint").alias("dias_disponibles"),
                    S.round_half_even(F.avg(d) * 100, 2).alias("disponibilidad_pct"),
                    S.round_half_even(F.avg(F.col("minimum_nights").cast("double")), 1).alias("noches_minimas_prom"))
               .orderBy("year", "month"))


def calendar_weekly_summary(cal: DataFrame, date_col: str = "date") -> DataFrame:
    """The same measures by ISO (week-year, week)."""
    d = _avail_num(cal)
    dt = F.col(date_col).cast("date") if dict(cal.dtypes).get(date_col) != "string" else S.parse_date(date_col)
    return (cal.withColumn("__d", dt).filter(F.col("__d").isNotNull())
               .groupBy(F.expr("extract(YEAROFWEEK FROM __d)").alias("iso_year"),
                        F.weekofyear("__d").alias("week"))
               .agg(F.count(F.lit(1)).cast("bigint").alias("total_dias"),
                    F.sum(d).cast("bigint").alias("dias_disponibles"),
                    S.round_half_even(F.avg(d) * 100, 2).alias("disponibilidad_pct"),
                    S.round_half_even(F.avg(F.col("minimum_nights").cast("double")), 1).alias("noches_minimas_prom"))
               .orderBy("iso_year", "week"))


def availability_by_month(cal: DataFrame, date_col: str = "date", flag_col: str = "available") -> DataFrame:
    """% available by ``yyyy-MM``; unknown flags are left out of the mean."""
    return (cal.withColumn("mes", S.month_period(S.parse_date(date_col)))
               .filter(F.col("mes").isNotNull())
               .groupBy("mes").agg((F.avg(S.flag_to_int(flag_col)) * 100).alias("disponibilidad_pct"))
               .orderBy("mes"))


def availability_crosstab(cal: DataFrame, date_col: str = "date", flag_col: str = "available",
                          values=("f", "t")) -> DataFrame:
    """Rows per month x flag value, missing cells 0.  Flags beyond ``values``
    are counted as ``other``, so the columns sum to the month's non-null flags."""
    flag = F.col(flag_col)
    return (cal.withColumn("mes", S.month_period(S.parse_date(date_col)))
               .filter(F.col("mes").isNotNull() & flag.isNotNull())
               .groupBy("mes").agg(*[F.count_if(flag == v).cast("bigint").alias(v) for v in values],
                                   F.count_if(~flag.isin(*values)).cast("bigint").alias("other"))
               .orderBy("mes"))


def value_counts(df: DataFrame, column: str, keep_null: bool = True, top: int | None = None) -> DataFrame:
    """Rows per value, descending (ties by value, nulls last); optionally the
    first ``top`` only (a TakeOrderedAndProject: each task keeps its own top
    rows, the driver merges k per task)."""
    src = df if keep_null else df.filter(F.col(column).isNotNull())
    out = (src.groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
              .orderBy(F.col("count").desc(), F.col(column).asc_nulls_last()))
    return out.limit(top) if top else out


def value_share(df: DataFrame, column: str, keep_null: bool = False, decimals: int | None = 2,
                denominator: str = "non_null") -> DataFrame:
    """Count and % per value.  ``denominator='non_null'`` divides by rows with a
    value (pandas ``value_counts(normalize=True)``); ``'all'`` by all rows."""
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("all"), F.count(F.col(column)).alias("non_null")))
    counts = value_counts(df, column, keep_null=keep_null)
    pct = F.col("count") * 100.0 / F.col("__t")[denominator]
    out = counts.withColumn("__t", total).withColumn("pct", S.round_half_even(pct, decimals) if decimals is not None else pct)
    return out.drop("__t").orderBy(F.col("count").desc(), F.col(column).asc_nulls_last())


def top_list_items(df: DataFrame, column: str = "amenities", k: int = 20) -> DataFrame:
    """Unnest an encoded list column and count each item; first ``k``."""
    items = df.select(F.explode(S.parse_list(column)).alias("item"))
    return (items.groupBy("item").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
                 .orderBy(F.col("count").desc(), F.col("item").asc_nulls_last()).limit(k))


def list_size_stats(df: DataFrame, column: str = "amenities") -> DataFrame:
    """Mean, max and min number of items of an encoded list column."""
    n = F.size(S.parse_list(column))
    return df.agg(F.avg(n).alias("mean_items"), F.max(n).cast("bigint").alias("max_items"),
                  F.min(n).cast("bigint").alias("min_items"))


def rows_per_year(df: DataFrame, date_col: str = "date", first_year: int | None = None) -> DataFrame:
    d = F.col(date_col)
    src = df.filter(d.isNotNull())
    if first_year is not None:
        src = src.filter(d >= F.lit(f"{first_year:04d}-01-01").cast("date"))
    return (src.groupBy(F.year(d).alias("year")).agg(F.count(F.lit(1)).cast("bigint").alias("total_reviews"))
               .orderBy("year"))


def rows_per_calendar_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows per month of the year 1..12 over all years; a month without rows
    is present with 0 (a 12-row spine joined to at most 12 grouped rows)."""
    counts = (df.filter(F.col(date_col).isNotNull())
                .groupBy(F.month(date_col).alias("month")).agg(F.count(F.lit(1)).alias("n")))
    spine = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return (spine.join(counts, "month", "left")
                 .select(F.col("month").cast("bigint").alias("month"),
                         F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("total_reviews"))
                 .orderBy("month"))


def date_range(df: DataFrame, date_col: str = "date", distinct_years: bool = False) -> DataFrame:
    d = F.col(date_col)
    aggs = [F.min(d).alias("first_date"), F.max(d).alias("last_date")]
    if distinct_years:
        aggs.append(F.count_distinct(F.year(d)).cast("bigint").alias("n_years"))
    return df.agg(*aggs)
