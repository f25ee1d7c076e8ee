"""Operators on small hand-made tables, plus invariants of the pipeline."""

from pyspark.sql import functions as F

from lodgespark.operators import cleaning as C
from lodgespark.operators import profiling as P
from lodgespark.operators import quality as Q
from lodgespark.operators import quantiles as QT
from lodgespark.operators import summaries as SM


def test_keep_first_is_deterministic_and_idempotent(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "z", 1), (None, "n", 1), (None, "m", 2)],
                               "id int, v string, w int")
    once = C.keep_first(df, ["id"], [F.col("v").asc()])
    assert sorted(map(tuple, once.collect()), key=str) == sorted([(1, "a", 3), (2, "z", 1), (None, "m", 2)], key=str)
    twice = C.keep_first(once, ["id"], [F.col("v").asc()])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_duplicate_count_treats_null_keys_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert C.duplicate_count(df, ["id"]).first()["duplicates"] == 2


def test_price_quartiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "price_clean double")
    r = P.price_quartiles(df).first()
    assert (r.q25, r.q50, r.q75) == (1.75, 2.5, 4.75)


def test_histogram_last_bin_closed_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.0,), (None,)], "x double")
    rows = {r.bin: r["count"] for r in P.histogram(df, "x", 4).collect()}
    assert rows == {0: 1, 1: 1, 2: 0, 3: 1}


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and abs(got[("a", "a")] - 1.0) < 1e-12


def test_impute_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "bedrooms string, maximum_nights string, availability_365 string, review_scores_rating string")
    r = C.impute_defaults(df).first()
    assert (r.bedrooms, r.maximum_nights, r.availability_365, r.review_scores_rating) == (1.0, 365.0, 0.0, None)


def test_fk_orphans_and_semi_join(spark):
    parents = spark.createDataFrame([("1",), ("2",)], "id string")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "id long, listing_id long")
    assert [r.id for r in Q.fk_orphans(child, parents).collect()] == [11]
    assert [r.id for r in Q.semi_join_valid_parents(child, parents).collect()] == [10]


def test_monthly_summary_counts_unknown_as_unavailable(spark):
    cal = spark.createDataFrame([(2024, 1, "2024-01-01", True, 2.0), (2024, 1, "2024-01-02", None, 4.0),
                                 (None, None, None, False, 1.0)],
                                "year int, month int, date string, is_available boolean, minimum_nights double")
    r = SM.calendar_monthly_summary(cal).collect()
    assert len(r) == 1
    assert (r[0].total_dias, r[0].dias_disponibles, r[0].disponibilidad_pct, r[0].noches_minimas_prom) == (2, 1, 50.0, 3.0)


def test_drop_sparse_columns(spark):
    df = spark.createDataFrame([(1, None, "a")] * 20 + [(2, None, None)], "id int, empty string, some string")
    assert C.drop_sparse_columns(df, 0.95).columns == ["id", "some"]


def test_value_counts_top_k_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in SM.value_counts(df, "k", top=2).collect()] == [("c", 2), ("a", 1)]


def test_exact_quantiles_equal_percentile_and_duckdb(spark):
    import duckdb
    from tests.conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for col in ["l_extendedprice", "l_quantity"]:
        a = li.agg(F.percentile(col, F.array(*map(F.lit, probs)))).first()[0]
        b = QT.exact_quantiles(li, col, probs).first()
        sql = ", ".join(f"quantile_cont({col}, {p})" for p in probs)
        d = duckdb.connect().execute(f"SELECT {sql} FROM '{SF_SMALL}/lineitem.parquet'").fetchall()[0]
        for x, y, z in zip(a, b, d):
            assert abs(x - y) <= 1e-9 * max(1.0, abs(x))
            assert abs(y - z) <= 1e-9 * max(1.0, abs(z))
    empty = QT.exact_quantiles(li.filter(F.col("l_orderkey") < 0), "l_quantity", [0.5]).first()
    assert empty[0] is None


def test_grouped_quantiles_with_null_groups_hot_values_and_many_parts(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(7.5)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.sqrt("id") - 50).alias("x"))
    want = {r.g: (r.n, r.q) for r in df.groupBy("g").agg(F.count("x").alias("n"), F.percentile("x", F.array(F.lit(0.25), F.lit(0.9))).alias("q")).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.g: (r.n, r.q) for r in QT.grouped_quantiles(df, ["g"], [0.25, 0.9]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0] and all(abs(a - b) < 1e-9 for a, b in zip(got[k][1], want[k][1]))


def test_quantiles_of_values_beyond_the_sketch(spark):
    """More rows than a sketch keeps, with values that repeat, infinities, NaN and a group of a third of all rows."""
    n = 300_000
    df = spark.range(n, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 5 == 0, F.lit(12.5)).when(F.col("id") % 1013 == 0, F.lit(float("inf"))).when(F.col("id") % 1019 == 0, F.lit(float("-inf")))
         .when(F.col("id") % 1021 == 0, F.lit(float("nan"))).otherwise(F.exp(F.pmod(F.hash("id"), F.lit(1000)) / 100.0)).alias("x"))
    probs = [0.0, 0.003, 0.25, 0.5, 0.999, 1.0]
    known = df.where(~F.isnan("x"))
    want = {r.g: (r.n, r.q) for r in known.groupBy("g").agg(F.count("x").alias("n"), F.percentile("x", F.array(*map(F.lit, probs))).alias("q")).collect()}
    got = {r.g: (r.n, r.q) for r in QT.grouped_quantiles(df, ["g"], probs).collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0]
        assert all(a == b or abs(a - b) < 1e-9 * max(1.0, abs(a)) for a, b in zip(got[k][1], want[k][1])), (k, got[k], want[k])
    one = QT.exact_quantiles(df, "x", probs).first()
    all_ = known.agg(F.percentile("x", F.array(*map(F.lit, probs)))).first()[0]
    assert all(a == b or abs(a - b) < 1e-9 * max(1.0, abs(a)) for a, b in zip(one, all_))


def test_a_bracket_that_misses_keeps_all_values(spark, monkeypatch):
    monkeypatch.setattr(QT, "MARGIN", -0.2)  # every bracket is empty
    df = spark.range(20_000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("x"))
    assert QT.exact_quantiles(df, "x", [0.5, 1.0]).first()[:] == (9999.5, 19999.0)
    assert QT.grouped_quantiles(df, ["k"], [0.0]).where("k = 3").first()["q"] == [3.0]


def test_quantiles_are_lazy_and_see_new_data(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").cast("double").alias("x")).write.parquet(path)
    built = QT.exact_quantiles(spark.read.parquet(path), "x", [0.5])
    spark.range(100, 101).select(F.col("id").cast("double").alias("x")).write.mode("append").parquet(path)
    assert built.first()[0] == 4.5  # the files known when it was built
    assert QT.exact_quantiles(spark.read.parquet(path), "x", [0.5]).first()[0] == 5.0


def test_null_safe_predicates_and_unknown_operators(spark):
    import pytest
    from lodgespark.sources import raw as R
    t = {"c": spark.createDataFrame([("t", 1), ("f", 2), (None, 3)], "available string, n int")}
    ids = lambda where: [r.n for r in R.extract(t, "c", where, limit=9, order_by=["n"]).collect()]
    assert ids({"available": None}) == [3] and ids({"available": {"$ne": "t"}}) == [2, 3]
    assert ids({"available": {"$in": ["t", None]}}) == [1, 3] and ids({"available": {"$nin": ["t"]}}) == [2, 3]
    assert ids({"n": {"$gte": 2, "$lt": 3}}) == [2] and ids({"available": {"$eq": None}}) == [3]
    with pytest.raises(ValueError, match="regex"):
        ids({"available": {"$regex": "x"}})


def test_crosstab_counts_every_flag(spark):
    cal = spark.createDataFrame([("2024-01-01", "t"), ("2024-01-02", "x"), ("2024-01-03", None)], "date string, available string")
    assert [tuple(r) for r in SM.availability_crosstab(cal).collect()] == [("2024-01", 0, 1, 1)]


def test_median_imputation_by_broadcast_and_by_salt(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 5.0), (None, None), ("a", 900.0)], "neighbourhood_cleansed string, price_clean double")
    for size in (0, 1 << 20):
        out = C.neighbourhood_median_impute(df, broadcast_bytes=size)
        assert ("__salt_g" in out._jdf.queryExecution().analyzed().toString()) == (size == 0)
        got = sorted(map(tuple, out.collect()), key=str)
        assert got == sorted([("a", 1.0, 1.0), ("a", 3.0, 3.0), ("a", None, 3.0), ("b", None, None), (None, 5.0, 5.0), (None, None, None),
                              ("a", 900.0, 900.0)], key=str)
    out = C.neighbourhood_median_impute(df, replace_outliers=True, k=0.5)
    assert {r.price_imputed for r in out.filter("price_clean = 900").collect()} == {3.0}


def test_salted_group_join_spreads_a_hot_group(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(8000, numPartitions=16).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"))
        values = rows.select(F.col("g").alias("__g"), F.length("g").alias("n")).distinct()
        out = C.join_group_values(rows, values, "g", 0)
        assert out.columns == ["g", "n"] and out.filter(F.length("g") == F.col("n")).count() == 8000
        tasks = [r["count"] for r in out.filter("g = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == 4000 and max(tasks) < 2800 and len(tasks) > 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_contract_names_missing_required_columns(spark):
    import pytest
    from lodgespark.contracts import ContractError
    from lodgespark.plans.transform import transform_calendar, transform_reviews
    cal = spark.createDataFrame([(1, "2024-01-01", "t")], "listing_id long, date string, available string")
    with pytest.raises(ContractError, match="minimum_nights"):
        transform_calendar(cal)
    # reviews without an id column: no dedup, still transformed (id is optional)
    rev = spark.createDataFrame([("2024-01-06", None)], "date string, comments string")
    r = transform_reviews(rev).first()
    assert (r.is_weekend, r.comments) == (1, "Sin comentario")
