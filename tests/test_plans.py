"""Plan checks: the shapes that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lodgespark import catalog as CAT
from lodgespark.operators import cleaning as C
from lodgespark.operators import profiling as P
from lodgespark.sources import raw as R
from lodgespark.session import scratch_path
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def opt(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


FAST_KEYS = ["transform_listings", "transform_reviews", "transform_calendar", "calendar_monthly_summary",
             "null_profile", "describe_numeric", "correlation_matrix", "iqr_outliers", "top_amenities",
             "histogram_price", "neighbourhood_median_impute", "quality_report", "count_list_items", "parse_list"]


@pytest.mark.parametrize("key", FAST_KEYS)
def test_no_python_udf_and_no_cross_join(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    p = plan(df) + opt(df)
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dedup_limits_rows_before_the_shuffle(spark):
    p = plan(C.keep_first(CAT.stamped(spark, SF_SMALL)["reviews"], ["id"]))
    # WindowGroupLimit ... Partial sits below the Exchange: a hot key sends at
    # most one row per map task.
    assert "Partial" in p and "WindowGroupLimit" in p
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_extract_pushes_filter_and_columns_to_the_scan(spark):
    path = scratch_path(spark, "plan-raw") + "/calendar"
    R.write_raw_zone(CAT.raw(spark, SF_SMALL)["calendar"], path)
    cat = {"calendar": spark.read.parquet(path)}
    df = R.extract(cat, "calendar", where={"available": "t"}, columns=["listing_id", "date"])
    p = plan(df)
    assert "PushedFilters: [IsNotNull(available), EqualTo(available,t)]" in p
    assert "ReadSchema: struct<listing_id:string,date:string,available:string>" in p


def test_null_profile_is_one_scan(spark):
    lst = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    p = plan(P.null_counts(lst))
    assert p.count("FileScan parquet") == 1


def test_quartiles_are_a_scalar_subquery_not_a_join(spark):
    p = plan(E.queries()["transform_listings"](spark, SF_SMALL))
    assert "Subquery" in p or "subquery" in p
    assert "Join" not in p.split("Subquery")[0]


def test_semi_join_uses_distinct_parent_keys(spark):
    df = E.queries()["semi_join_valid_parents"](spark, SF_SMALL)
    p = opt(df)
    assert "LeftSemi" in p and "Aggregate" in p


def test_listing_quartiles_are_one_subquery(spark):
    # the (q25, q50, q75) struct is projected once: one scalar subquery, so
    # the quartile aggregate (and the dedup under it) runs as one job
    import re
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    p = opt(E.queries()["transform_listings"](spark, SF_SMALL))
    # the thresholds, and the two brackets they are found with; not one per quartile
    assert len(set(re.findall(r"scalar-subquery#(\d+)", p))) == 3


def test_one_dedup_window_per_table(spark):
    from lodgespark.plans import transform as T
    for table in ("reviews", "calendar"):
        p = opt(T.transform_all({table: CAT.stamped(spark, SF_SMALL)[table]})[table])
        assert p.count("Window [") == 1 and p.count("Relation ") == 1
    # listings: the rows are deduplicated once; the quartiles read the deduplicated prices and no other column
    p = opt(T.transform_listings(CAT.stamped(spark, SF_SMALL)["listings"]))
    rows = [line for line in p.splitlines() if "Relation " in line]
    assert len(rows) == len([line for line in p.splitlines() if "Window [row_number" in line]) == 4
    assert len([line for line in p.splitlines() if "Project [" in line and "host_name" in line]) >= 1


def test_quantiles_do_not_merge_values_in_one_task(spark):
    from lodgespark.operators.quantiles import exact_quantiles, grouped_quantiles
    df = spark.range(100).select(F.lit(0).alias("g"), F.col("id").cast("double").alias("x"))
    for q in (grouped_quantiles(df, ["g"], [0.5]), exact_quantiles(df, "x", [0.5])):
        assert "percentile" not in plan(q)
    assert "SinglePartition" not in plan(grouped_quantiles(df, ["g"], [0.5]))
    # two sketches, then only what their brackets hold is counted by value
    assert opt(exact_quantiles(df, "x", [0.5])).count("kll_sketch_agg_double") == 2


def test_values_are_never_broadcast_to_meet_their_brackets(spark):
    """Repeated values shuffle to few bytes, in a stage that ends before the brackets are known."""
    from lodgespark.operators import profiling as P
    from lodgespark.operators.quantiles import grouped_quantiles
    df = spark.range(0, 400_000, 1, 4).select((F.col("id") % 5).cast("double").alias("a"), F.lit(1.0).alias("b"))
    grouped = grouped_quantiles(P.values_long(df, ["a", "b"]), ["column"], [0.5])
    described = P.describe_numeric(df, ["a", "b"])
    assert {r["column"]: r["q"] for r in grouped.collect()} == {"a": [2.0], "b": [1.0]}
    assert {r["column"]: (r["p25"], r["p75"]) for r in described.collect()} == {"a": (1.0, 3.0), "b": (1.0, 1.0)}
    for q in (grouped, described):
        p = q._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in p and "BuildLeft" not in p


def test_frames_run_no_job_while_they_are_built(spark):
    from lodgespark.operators import profiling as P
    from lodgespark.plans import transform as T
    raw = CAT.stamped(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "frames that are only built")
    try:
        T.transform_all(raw)
        P.describe_numeric(CAT.listings_numeric(spark, SF_SMALL), ["price_num"])
        P.price_quartiles(CAT.listings_numeric(spark, SF_SMALL), "price_num")
        assert list(tracker.getJobIdsForGroup("built")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reference_state_is_one_join(spark):
    from lodgespark.operators import quality as Q
    c = CAT.raw(spark, SF_SMALL)
    assert opt(Q.reference_state(c["reviews"], c["listings"])).count("Join ") == 1


def test_a_date_is_parsed_once_a_row(spark):
    from lodgespark.functions import scalars as S
    from lodgespark.plans import transform as T
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    for table, step in (("reviews", T.transform_reviews), ("calendar", T.transform_calendar)):
        assert opt(step(CAT.stamped(spark, SF_SMALL)[table])).count(S._ISO_DATE) == 1
        # a stage's method above this size is never compiled: Spark has to split it, in any session
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def test_rows_move_for_no_key_rule_where_few_keys_repeat(spark):
    from pyspark.sql.types import LongType, StructField, StructType
    from lodgespark.operators import quality as Q
    schema = StructType([StructField("id", LongType())])
    once = spark.range(2000).select("id", F.col("id").alias("__row"))
    judged = Q.first_violation(once, schema, ["id"], place=["__row"])
    assert "Exchange" not in plan(judged) and judged.where("violation IS NULL").count() == 2000
    twice = once.unionByName(spark.range(3).select("id", (F.col("id") + 5000).alias("__row")))
    judged = Q.first_violation(twice, schema, ["id"], place=["__row"])
    assert "SortMergeJoin" not in plan(judged) and "hashpartitioning" not in plan(judged)
    assert [(r["id"], r["__row"]) for r in judged.where("violation = 'duplicate_key'").orderBy("id").collect()] == [(i, i + 5000) for i in range(3)]
