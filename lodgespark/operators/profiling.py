"""Table profiles: nulls, descriptive statistics, outliers, histograms and
correlations.

Null counts and correlations are one aggregate over the table; profiles of
many numeric columns read it in long form, (column, value).  Statistics that
are applied back to rows (bounds, thresholds) are one-row results used as
scalar subqueries: computed once and inlined, one row whatever the table size.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgespark.operators.cleaning import filter_upper_percentile
from lodgespark.operators.quantiles import exact_quantiles, grouped_quantiles


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row aggregate as a struct-valued scalar subquery.  Spark runs it
    once and inlines its value into every task, so applying a global
    statistic to all rows needs no join and ships one row, whatever the
    table size."""
    return one_row.select(F.struct(*one_row.columns).alias("s")).scalar()


# ---------------------------------------------------------------- nulls

def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, rows) for every column, from one aggregate."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"known__{i}") for i, c in enumerate(cols)]]
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), (F.col("__rows") - F.col(f"known__{i}")).cast("bigint").alias("nulls"),
                        F.col("__rows").cast("bigint").alias("rows")) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def null_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """% null per column (0-100), only columns with nulls, descending (ties by
    name); all of them, or the first ``top``."""
    nc = null_counts(df)
    out = (nc.filter(F.col("nulls") > 0)
             .select("column", (F.col("nulls") / F.col("rows") * 100).alias("null_pct"))
             .orderBy(F.col("null_pct").desc(), F.col("column").asc()))
    return out.limit(top) if top else out


def null_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, columns that hold a null, mean null % over columns."""
    parts = []
    for name, df in tables.items():
        nc = null_counts(df)
        parts.append(nc.agg(
            F.lit(name).alias("table_name"),
            F.max("rows").alias("rows"),
            F.sum((F.col("nulls") > 0).cast("long")).cast("bigint").alias("cols_with_nulls"),
            F.avg(F.try_divide(F.col("nulls"), F.col("rows")) * 100).alias("mean_null_pct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- statistics

def price_quartiles(df: DataFrame, column: str = "price_clean") -> DataFrame:
    """q25, q50, q75 and median of the non-null values (zeros included)."""
    return exact_quantiles(df, column, [0.25, 0.5, 0.75]).select("*").toDF("q25", "q50", "q75").withColumn("median", F.col("q50"))


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _lit(c: str) -> str:
    return "'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, x) with one row per input row and column, as one SQL
    generator expression; the grouped aggregates that follow consume it in
    the same task (partial aggregation), so nothing is shuffled per row."""
    items = ", ".join(f"struct({_lit(c)} AS column, CAST({_q(c)} AS DOUBLE) AS x)" for c in columns)
    return df.select(F.expr(f"inline(array({items}))"))


QUARTILES = [0.25, 0.5, 0.75]


def describe_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """count, mean, sample std, min, exact 25/50/75 %, max per column
    (unlike ``DataFrame.summary``, whose quartiles are approximate)."""
    cols = [c for c in columns if c in df.columns]
    long = values_long(df, cols)
    g = long.groupBy("column").agg(
        F.count("x").cast("bigint").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    q = grouped_quantiles(long, ["column"], QUARTILES, few=True).select("column", "q")
    return g.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def _column_stats(long: DataFrame) -> Column:
    """Per-column quartiles and mean as a map column -> stats, computed once
    (a scalar subquery); its size is bounded by the number of columns."""
    means = long.groupBy("column").agg(F.avg("x").alias("mean"))
    stats = means.join(grouped_quantiles(long, ["column"], QUARTILES, few=True).select("column", "q"), "column", "left")
    one = stats.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("q", "mean")))).alias("m"))
    return one.scalar()


def iqr_outliers(df: DataFrame, columns: Iterable[str], k: float = 1.5) -> DataFrame:
    """Per variable: Q1, Q3, IQR, bounds at ``k`` IQR, counts above / below /
    either, % of non-null rows, mean and median.  Two passes: the quartiles
    (a per-column map, computed once) and the conditional counts."""
    cols = [c for c in columns if c in df.columns]
    long = values_long(df, cols)
    m = _column_stats(long)
    s = F.col("__m")[F.col("column")]
    q1, q3 = s["q"][0], s["q"][2]
    x = F.col("x")
    counts = (long.withColumn("__m", m).groupBy("column").agg(
        F.count(x).alias("n"), F.sum((x > q3 + k * (q3 - q1)).cast("long")).alias("n_above"),
        F.sum((x < q1 - k * (q3 - q1)).cast("long")).alias("n_below")))
    out = counts.withColumn("__m", m)
    q1, med, q3 = s["q"][0], s["q"][1], s["q"][2]
    n_above = F.coalesce(F.col("n_above"), F.lit(0)).cast("bigint")
    n_below = F.coalesce(F.col("n_below"), F.lit(0)).cast("bigint")
    return out.select(
        "column", F.col("n").cast("bigint").alias("n"), q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        (q1 - k * (q3 - q1)).alias("lower_bound"), (q3 + k * (q3 - q1)).alias("upper_bound"),
        n_above.alias("n_above"), n_below.alias("n_below"), (n_above + n_below).alias("n_outliers"),
        F.try_divide((n_above + n_below) * 100.0, F.col("n")).alias("pct_outliers"),
        s["mean"].alias("mean"), med.alias("median"))


def boxplot_stats(df: DataFrame, columns: Iterable[str], whis: float = 1.5) -> DataFrame:
    """Box summary per variable: quartiles, median, whiskers at the last data
    point inside ``whis`` IQR of the box, and the number of points outside."""
    cols = [c for c in columns if c in df.columns]
    long = values_long(df, cols)
    m = _column_stats(long)
    s = F.col("__m")[F.col("column")]
    q1, q3 = s["q"][0], s["q"][2]
    x = F.col("x")
    inside = x.isNotNull() & (x >= q1 - whis * (q3 - q1)) & (x <= q3 + whis * (q3 - q1))
    g = long.withColumn("__m", m).groupBy("column").agg(
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum((x.isNotNull() & ~inside).cast("long")).alias("n_fliers"))
    return g.withColumn("__m", m).select(
        "column", s["q"][0].alias("q1"), s["q"][1].alias("median"), s["q"][2].alias("q3"), "whisker_low",
        "whisker_high", F.coalesce(F.col("n_fliers"), F.lit(0)).cast("bigint").alias("n_fliers"))


def outlier_flag(df: DataFrame, column: str = "price_clean", k: float = 3.0,
                 out_col: str = "price_outlier") -> DataFrame:
    """Row flag: value outside [Q1 - k IQR, Q3 + k IQR]; null value -> false."""
    x = F.col(column)
    q = exact_quantiles(df, column, [0.25, 0.75]).select(F.array("*")).scalar()
    return df.withColumn("__q", q).withColumn(
        out_col, F.coalesce((x < F.col("__q")[0] - k * (F.col("__q")[1] - F.col("__q")[0]))
                            | (x > F.col("__q")[1] + k * (F.col("__q")[1] - F.col("__q")[0])), F.lit(False))
    ).drop("__q")


def histogram(df: DataFrame, column: str, bins: int, upper_quantile: float | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] of the non-null values (after an
    optional cut at a quantile), last bin closed: (bin, lower, upper, count).
    Empty bins are present with count 0 (a spine of ``bins`` rows joined to
    the grouped counts)."""
    x = F.col(column).cast("double")
    data = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    if upper_quantile is not None:
        data = filter_upper_percentile(data, "x", upper_quantile)
    rng = scalar_row(data.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    lo, hi = F.col("__r.lo"), F.col("__r.hi")
    width = (hi - lo) / bins
    b = F.least(F.coalesce(F.floor(F.try_divide(F.col("x") - lo, width)), F.lit(0)).cast("bigint"),
                F.lit(bins - 1).cast("bigint"))
    counts = (data.withColumn("__r", rng).select(b.alias("bin"))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spine = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (spine.join(counts, "bin", "left").withColumn("__r", rng)
                 .filter(hi.isNotNull())
                 .select("bin", (lo + F.col("bin") * width).alias("lower"),
                         (lo + (F.col("bin") + 1) * width).alias("upper"),
                         F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


# ---------------------------------------------------------------- correlation

def _pair_corr(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(p, corr) per pair that has complete rows: Pearson's correlation, null
    (not an error) for a constant or single-row input, where ``corr`` raises
    under ANSI.

    Every row gives its complete pairs as short rows, which the same task adds
    to one small group of central moments a pair; so the generated code has
    three aggregates whatever the number of pairs, and one row a pair and task
    is shuffled.
    """
    items = ", ".join(f"struct({i} AS p, CAST({_q(a)} AS DOUBLE) AS x, CAST({_q(b)} AS DOUBLE) AS y)" for i, (a, b) in enumerate(pairs))
    if not items:
        return df.sparkSession.createDataFrame([], "p int, corr double")
    complete = df.select(F.expr(f"inline(array({items}))")).where("x IS NOT NULL AND y IS NOT NULL")
    return complete.groupBy("p").agg(F.try_divide(F.covar_samp("x", "y"), F.stddev_samp("x") * F.stddev_samp("y")).alias("corr"))


def correlation_matrix(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Long-form Pearson matrix (col_a, col_b, corr) over all ordered pairs,
    pairwise-complete rows, null for a constant or single-row column."""
    cols = [c for c in columns if c in df.columns]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    names = df.sparkSession.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)] + [(i, b, a) for i, (a, b) in enumerate(pairs) if a != b],
        "p int, col_a string, col_b string")
    return names.join(_pair_corr(df, pairs), "p", "left").select("col_a", "col_b", "corr")


def correlation_with(df: DataFrame, target: str, columns: Iterable[str]) -> DataFrame:
    """Correlation of every other variable with ``target``, descending."""
    cols = [c for c in columns if c in df.columns and c != target]
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "p int, column string")
    return (names.join(_pair_corr(df, [(c, target) for c in cols]), "p", "left").select("column", "corr")
            .orderBy(F.col("corr").desc_nulls_last(), F.col("column")))


# ---------------------------------------------------------------- distinct values

def distinct_values(df: DataFrame, columns: Iterable[str], keep_null: Iterable[str] = ()) -> DataFrame:
    """(column, value) for the distinct values of each column; nulls only for
    the columns in ``keep_null``.  One unpivot and one distinct (partial
    aggregation before the shuffle)."""
    cols = [c for c in columns if c in df.columns]
    keep = set(keep_null)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("r")
    ).select("r.*")
    long = long.filter(F.col("value").isNotNull() | F.col("column").isin(*keep) if keep else F.col("value").isNotNull())
    return long.distinct()
