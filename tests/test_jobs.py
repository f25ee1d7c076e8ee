"""The zone-to-zone jobs on the small test tables."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodgespark import catalog as CAT
from lodgespark.operators import quality as Q
from lodgespark.operators.cleaning import ORDINAL, keep_first
from lodgespark.plans.jobs import IngestError, ingest_job, publish_job, read_clean, transform_job
from lodgespark.session import scratch_path
from lodgespark.sources import zones as Z
from lodgespark.sources.raw import CORRUPT_COLUMN, read_raw_zone, scan_raw_csv
from tests.conftest import SF_SMALL


def landing(spark, root, name, text):
    path = Path(root.removeprefix("file:")) / "landing" / name
    path.mkdir(parents=True)
    (path / "part.csv").write_text(text)
    return str(path)


def test_ingest_keeps_bad_rows_apart_and_reports_causes(spark):
    root = scratch_path(spark, "ingest-test")
    good = 'id,comments,date\n1,"two\nlines, and a comma",2020-01-01\n2,short\n3,a,b,c\n4,"x ""y""",N/A\n'
    files = {"reviews": (landing(spark, root, "reviews", good), ["date", "id", "comments", "reviewer_id"]),
             "calendar": (f"{root}/landing/missing", ["listing_id"])}
    res = {r.table_name: r for r in ingest_job(spark, files, f"{root}/raw").collect()}
    assert tuple(res["reviews"])[1:] == (2, 2, "OK", None)
    assert res["calendar"].status == "FALLO" and res["calendar"].rows == 0 and "PATH_NOT_FOUND" in res["calendar"].error
    ok, bad = read_raw_zone(spark, f"{root}/raw/reviews")
    assert ok.count() == 2 and bad.count() == 2
    rows = [tuple(r) for r in ok.orderBy(ORDINAL).select("id", "comments", "date", "reviewer_id").collect()]
    assert rows == [("1", "two\nlines, and a comma", "2020-01-01", None), ("4", 'x "y"', None, None)]
    assert sorted(r[0] for r in bad.select(CORRUPT_COLUMN).collect()) == ["2,short", "3,a,b,c"]
    assert [r.id for r in scan_raw_csv(spark, files["reviews"][0], ["id"]).collect()] == ["1", "4"]
    assert scan_raw_csv(spark, files["reviews"][0], ["id"]).count() == 2
    with pytest.raises(IngestError, match="calendar"):
        ingest_job(spark, files, f"{root}/raw2", strict=True)


def test_header_order_does_not_matter_and_first_occurrence_stays(spark):
    root = scratch_path(spark, "order-test")
    path = landing(spark, root, "t", "b,a\n9,k\n2,k\n5,m\n")
    df = scan_raw_csv(spark, path, ["a", "b"], ordinal=True, partitions=4)
    assert sorted((r.a, r.b) for r in keep_first(df, ["a"]).collect()) == [("k", "9"), ("m", "5")]
    with pytest.raises(ValueError, match="order"):
        keep_first(df.drop(ORDINAL), ["a"])


def test_transform_then_publish(spark):
    root = scratch_path(spark, "jobs-test")
    raw = CAT.stamped(spark, SF_SMALL)
    counts = transform_job(raw, f"{root}/clean")
    clean = read_clean(spark, f"{root}/clean")
    assert counts == {k: v.count() for k, v in clean.items()}
    # invariants: rows in = rows out + duplicates; summary days = calendar rows with a date
    assert counts["listings"] == raw["listings"].select("id").distinct().count()
    assert counts["calendar"] == raw["calendar"].select("listing_id", "date").distinct().count()
    days = clean["calendar_summary"].agg(F.sum("total_dias")).first()[0]
    assert days == clean["calendar"].filter(F.col("date").isNotNull()).count()
    # every rule is broken by some row: fail publishes nothing, quarantine accounts for all rows
    with pytest.raises(ValueError, match="orphan:listing_id"):
        publish_job(spark, f"{root}/clean", f"{root}/failed", policy="fail")
    assert "listings" not in read_names(spark, f"{root}/failed")
    out = publish_job(spark, f"{root}/clean", f"{root}/serving", policy="quarantine").collect()
    for t, n in counts.items():
        assert sum(r.rows for r in out if r.table_name == t) == n
        assert spark.read.parquet(f"{root}/serving/{t}").count() == sum(r.rows for r in out if r.table_name == t and r.outcome == "published")
    assert {r.outcome for r in out} >= {"published", "type:id", "type:bedrooms", "not_null:listing_id", "orphan:listing_id", "not_null:date"}
    aside = spark.read.parquet(f"{root}/serving/_quarantine/listings")
    assert aside.filter("violation = 'type:bedrooms'").select("bedrooms").distinct().collect()[0][0] == 1.5  # as it was
    assert spark.read.parquet(f"{root}/serving/reviews").agg(F.max(F.length("comments"))).first()[0] == 5000


def read_names(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def test_publish_takes_the_tables_that_are_there(spark):
    root = scratch_path(spark, "partial-test")
    transform_job({"calendar": CAT.stamped(spark, SF_SMALL)["calendar"]}, f"{root}/clean")
    out = publish_job(spark, f"{root}/clean", f"{root}/serving", policy="quarantine").collect()
    assert {r.table_name for r in out} == {"calendar", "calendar_summary"}


def test_violations_route_every_row_once(spark):
    parents = spark.createDataFrame([("1",), ("2.0",), ("abc",)], "id string")
    child = spark.createDataFrame([("1", "1"), ("2", "2"), ("3", "9"), ("4", None), ("5", "abc"), ("01", "1"), ("x", "1")], "id string, listing_id string")
    child = child.withColumn("at", F.when(F.col("id") == "01", 2).otherwise(1))  # places need only tell rows of one key apart
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("id", LongType()), StructField("listing_id", LongType(), False)])
    got = {r.id: r.violation for r in Q.first_violation(child, schema, ["id"], ["listing_id"], {"listing_id": (parents, "id")}, place=["at"]).collect()}
    assert got == {"1": None, "01": "duplicate_key", "2": None, "3": "orphan:listing_id", "4": "not_null:listing_id", "5": "type:listing_id", "x": "type:id"}
    assert {r.id: r.reference for r in Q.reference_state(child, parents).collect()} == {
        "1": "ok", "2": "ok", "3": "orphan", "4": "null_key", "5": "orphan", "01": "ok", "x": "ok"}


def test_layout_writes_few_files_per_folder(spark):
    import glob
    from lodgespark.sources import zones as Z
    cal = spark.read.parquet(f"{CAT._serving_zone(spark, SF_SMALL)}/calendar")
    path = scratch_path(spark, "layout-test") + "/calendar"
    Z.layout_by_keys(cal, path, ["listing_id", "date"], partition_by=["year", "month"], partitions=8)
    folders = glob.glob(f"{path}/year=*/month=*")
    files = glob.glob(f"{path}/year=*/month=*/*.parquet")
    # contiguous ranges: at most one extra file per task boundary
    assert len(files) <= len(folders) + 8
    assert spark.read.parquet(path).count() == cal.count()


def test_duplicate_rule_with_hot_keys(spark):
    """A third of the rows has one junk id, a third one valid id: every row is judged once, the first occurrence stays."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])
    n = 6000
    rows = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "junk").when(F.col("id") % 3 == 1, F.when(F.col("id") % 2 == 0, "7").otherwise("07"))
         .otherwise(F.concat(F.lit("1"), F.col("id"))).alias("id"),
        F.lit("same").alias("v"), F.lit("f").alias("__file"), (n - F.col("id")).alias("__row"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        judged = Q.first_violation(rows, schema, ["id"], place=["__file", "__row"])
        assert "Window" not in judged._jdf.queryExecution().optimizedPlan().toString()
        # the rows that are broken already do not meet in one task: their join key is their own hash
        tasks = Counter(r["p"] for r in judged.select("violation", F.spark_partition_id().alias("p")).collect() if r["violation"] == "type:id")
        assert max(tasks.values()) < n / 3 / 4
        got = {(r["violation"], r["n"]) for r in judged.groupBy("violation").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == {("type:id", n // 3), ("duplicate_key", n // 3 - 1), (None, n // 3 + 1)}
        kept = judged.where("violation IS NULL AND id IN ('7', '07')").collect()
        assert [r["__row"] for r in kept] == [rows.where("id IN ('7', '07')").agg(F.min("__row")).first()[0]]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_key_rule_needs_places(spark):
    from pyspark.sql.types import LongType, StructField, StructType
    with pytest.raises(ValueError, match="order the rows"):
        Q.first_violation(spark.range(3), StructType([StructField("id", LongType())]), ["id"])


def scanned_rows(df):
    """Rows that the file scans of `df` hand on when it runs: those of row groups that are skipped are not among them."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_z_order_key_interleaves_the_bits(spark):
    points = [(0.0, 0.0), (-90.0, -180.0), (90.0, 180.0), (40.4, -3.7), (-33.9, 151.2)]

    def brute(lat, lon):
        y, x = (min(max(int((v + half) / (2 * half) * (1 << 31)), 0), (1 << 31) - 1) for v, half in ((lat, 90), (lon, 180)))
        return sum((x >> i & 1) << (2 * i) | (y >> i & 1) << (2 * i + 1) for i in range(31))

    df = spark.createDataFrame([(str(a), str(b)) for a, b in points] + [("x", "1"), (None, None)], "a string, b string")
    got = [r["z"] for r in df.select(Z.place_key("a", "b").alias("z")).collect()]
    assert got == [brute(a, b) for a, b in points] + [None, None]


def test_every_access_path_skips_row_groups(spark):
    n = 40_000
    lst = spark.range(n).select(
        F.concat(F.lit("L"), F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("id"), F.concat(F.lit("h"), F.pmod(F.hash("id"), F.lit(9000))).alias("host_id"),
        F.concat(F.lit("n"), (F.col("id") / 400).cast("int")).alias("neighbourhood_cleansed"), F.when(F.col("id") < 300, "rare").otherwise("usual").alias("room_type"),
        (40 + F.floor(F.col("id") / 200) / 200).cast("string").alias("latitude"), (-3 - (F.col("id") % 200) / 200).cast("string").alias("longitude"))
    rev = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("id"), (F.col("id") % 500).alias("listing_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 400).cast("int")).alias("date"))
    dated = rev.withColumns({"year": F.year("date"), "month": F.month("date")})
    root = scratch_path(spark, "paths")
    out = {}
    for name, df in (("listings", lst), ("reviews", dated), ("calendar", dated)):
        Z.layout_table(df, f"{root}/{name}", name, partitions=8, row_group_bytes=20_000)
        out[name] = spark.read.parquet(f"{root}/{name}")
        assert sorted(map(str, out[name].select(*df.columns).collect())) == sorted(map(str, df.collect()))  # same rows, columns in place
    one = lst.first()
    probes = [("listings", f"id = '{one['id']}'"), ("listings", "host_id = 'h4321'"), ("listings", "neighbourhood_cleansed = 'n7'"),
              ("listings", "room_type = 'rare'"), ("listings", "latitude > '40.30' AND latitude < '40.35' AND longitude > '-3.30' AND longitude < '-3.20'"),
              ("reviews", f"id = {rev.first()['id']}"), ("reviews", "listing_id = 77"), ("reviews", "date = DATE '2020-02-20'"),
              ("reviews", "listing_id = 77 AND date >= DATE '2020-02-20'"),
              ("calendar", "listing_id = 77"), ("calendar", "date = DATE '2020-02-20' AND year = 2020 AND month = 2"), ("calendar", "listing_id = 77 AND date = DATE '2020-02-20'")]
    for name, where in probes:
        read = scanned_rows(out[name].where(where))
        assert 0 < read < n * 0.6 or out[name].where(where).count() == 0 and read < n * 0.6, (name, where, read)


def test_queries_store_only_the_tables_they_read(spark, monkeypatch):
    from lodgespark.sources import raw as R
    written, write = [], R.write_raw_zone
    monkeypatch.setattr(R, "write_raw_zone", lambda df, path: written.append((path.rsplit("/", 1)[1], df)) or write(df, path))
    monkeypatch.setattr(CAT, "_MEMO", {})
    monkeypatch.setattr(CAT, "_LEAST_SPLIT", 0)  # as for a source that gives every core a task
    CAT.raw(spark, SF_SMALL)["reviews"].count()
    assert [t for t, _ in written] == ["reviews"]
    assert CAT.clean(spark, SF_SMALL)["calendar_summary"].count() > 0
    assert [t for t, _ in written] == ["reviews", "calendar"]
    assert CAT._published(spark, SF_SMALL, "calendar").count() > 0
    assert [t for t, _ in written] == ["reviews", "calendar", "listings"]
    for t, df in written:
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert CAT.stamped(spark, SF_SMALL)[t].count() == df.count()
    assert set(read_names(spark, CAT._clean_zone(spark, SF_SMALL, []))) == {"calendar_clean", "calendar_summary_clean", "listings_clean"}
    assert {t: n for t, n in CAT.clean(spark, SF_SMALL)["reviews"].dtypes}["date"] == "date"  # and the rest when it is asked for
