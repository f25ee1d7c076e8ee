"""Versioned refreshes, the run log, the entry points, and counts from footers."""

import glob

import pytest
from pyspark.sql import functions as F

from lodgespark import app
from lodgespark import catalog as CAT
from lodgespark.operators import metrics as M
from lodgespark.operators import profiling as P
from lodgespark.plans import jobs as J
from lodgespark.session import scratch_path
from lodgespark.sources import raw as R
from lodgespark.sources import versions as V
from tests.conftest import SF_SMALL


def write(df, say=None):
    def fill(folder):
        df.write.parquet(folder)
        return {"": df.count() if say is None else say}
    return fill


def ids(spark, root):
    return sorted(r.id for r in spark.read.parquet(V.current(spark, root)).collect())


def test_a_refresh_that_dies_leaves_the_old_rows(spark):
    root = scratch_path(spark, "refresh")
    assert V.current(spark, root) == root and V.versions(spark, root) == []
    V.refresh(spark, root, write(spark.range(3)))
    assert ids(spark, root) == [0, 1, 2]

    def dies(folder):
        spark.range(9).write.parquet(folder)
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        V.refresh(spark, root, dies)
    boom = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("task died"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="task died"):
        V.refresh(spark, root, lambda folder: boom.write.parquet(folder))
    with pytest.raises(V.RefreshError, match="5 rows in its files, 6"):
        V.refresh(spark, root, write(spark.range(5), say=6))
    with pytest.raises(V.RefreshError, match="no rows"):
        V.refresh(spark, root, write(spark.range(0)))
    assert ids(spark, root) == [0, 1, 2]
    # a rerun gives the rows of a run that was never broken
    V.refresh(spark, root, write(spark.range(5)))
    assert ids(spark, root) == [0, 1, 2, 3, 4] and len(V.versions(spark, root)) == 2
    V.refresh(spark, root, write(spark.range(0)), may_be_empty=True)
    assert ids(spark, root) == []


def test_old_and_unfinished_versions_go(spark):
    root = scratch_path(spark, "refresh-keep")
    for n in range(1, 4):
        V.refresh(spark, root, write(spark.range(n)), keep=2)
    assert len(V.versions(spark, root)) == 2 and len(glob.glob(f"{root.removeprefix('file:')}/v-*")) == 2
    spark.range(1).write.parquet(f"{root}/v-unfinished")
    assert V.drop_old_versions(spark, root, 2) == []
    assert V.drop_old_versions(spark, root, 1, unfinished=True)[-1] == "v-unfinished"
    assert ids(spark, root) == [0, 1, 2] and len(glob.glob(f"{root.removeprefix('file:')}/v-*")) == 1
    with pytest.raises(ValueError):
        V.drop_old_versions(spark, root, 0)


def test_later_pointer_holds_whatever_its_version_is_called(spark):
    root = scratch_path(spark, "refresh-order")
    for name in ("v-z", "v-a"):
        spark.range(1).write.parquet(f"{root}/{name}")
        V.switch(spark, root, name)
    assert V.current(spark, root) == f"{root}/v-a"


def test_run_log_replaces_a_stage_and_keeps_the_others(spark):
    root = scratch_path(spark, "log")
    one = M.ingest_records([("t", 5, 1, "OK", None)])
    M.append_run_log(spark, root, "a", "ingest", one)
    M.append_run_log(spark, root, "a", "ingest", one)
    M.append_run_log(spark, root, "b", "ingest", M.ingest_records([("t", 0, 0, "FALLO", "x")]))
    M.append_run_log(spark, root, "b", "publish", M.publish_records([("t", "published", 3), ("t", "duplicate_key", 2)]))
    log = M.read_run_log(spark, root)
    got = {(r.run_id, r.stage, r.metric): r.value for r in log.collect()}
    assert log.count() == len(got) == 12
    assert got["a", "ingest", "rows_in"] == 6 and got["b", "ingest", "failed"] == 1
    assert got["b", "publish", "set_aside:duplicate_key"] == 2 and got["b", "publish", "rows_in"] == 5
    assert M.unbalanced_runs(log).count() == 0
    M.append_run_log(spark, root, "c", "transform", [{"stage": "transform", "table": "t", "metric": m, "value": v}
                                                     for m, v in (("rows_in", 9), ("rows_out", 5), ("duplicates_dropped", 3))])
    assert [tuple(r) for r in M.unbalanced_runs(M.read_run_log(spark, root)).collect()] == [("c", "transform", "t", 1.0)]
    for run, stage in (("a/b", "ingest"), ("", "ingest"), ("a", "other")):
        with pytest.raises(ValueError):
            M.append_run_log(spark, root, run, stage, one)


def test_entry_points_from_files_to_serving_tables(spark, capsys):
    root = scratch_path(spark, "app")
    for t, df in CAT.raw(spark, SF_SMALL).items():
        R.write_csv_gz(df, f"{root}/landing/{t}")
    log = ["--log", f"{root}/log", "--run-id", "r1"]
    assert app.main(["ingest", "--landing", f"{root}/landing", "--raw", f"{root}/raw", *log], spark) == 0
    assert app.main(["transform", "--raw", f"{root}/raw", "--clean", f"{root}/clean", *log], spark) == 0
    # rows that break a rule stop the strict policy and nothing is published
    assert app.main(["publish", "--clean", f"{root}/clean", "--serving", f"{root}/serving", *log], spark) == 1
    assert V.versions(spark, f"{root}/serving") == []
    assert app.main(["publish", "--clean", f"{root}/clean", "--serving", f"{root}/serving", "--policy", "quarantine", *log], spark) == 0
    log_rows = M.read_run_log(spark, f"{root}/log")
    assert {r.stage for r in log_rows.select("stage").distinct().collect()} == {"ingest", "transform", "publish"}
    assert M.unbalanced_runs(log_rows).count() == 0
    served = V.current(spark, f"{root}/serving")
    said = {r.table: r.value for r in log_rows.filter("metric = 'rows_published'").collect()}
    assert said == {t: spark.read.parquet(f"{served}/{t}").count() for t in said} and len(said) == 4
    # a second run with one landing table missing: that table is reported and its last rows stay
    before = R.read_raw_zone(spark, f"{root}/raw/reviews")[0].count()
    assert app.main(["ingest", "--landing", f"{root}/nothing", "--raw", f"{root}/raw", "--tables", "reviews"], spark) == 1
    assert R.read_raw_zone(spark, f"{root}/raw/reviews")[0].count() == before
    # a transform whose raw zone is missing fails and the clean zone stays
    assert app.main(["transform", "--raw", f"{root}/none", "--clean", f"{root}/clean"], spark) == 1
    assert J.read_clean(spark, f"{root}/clean")["reviews"].count() > 0
    assert app.main(["publish", "--clean", "x"], spark) == 2 and app.main([], spark) == 2
    assert app.main(["ingest", "--landing", "x", "--raw", "y", "--keep", "0"], spark) == 2
    capsys.readouterr()


def test_profiles_read_no_data_pages(spark):
    root = scratch_path(spark, "footers")
    long = F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), F.repeat(F.col("id").cast("string"), 5000)))
    df = spark.range(300).select(F.col("id").cast("string").alias("id"), long.alias("comments"), F.lit(None).cast("string").alias("none"),
                                 F.struct("id").alias("place"))
    R.write_raw_zone(df.repartition(3), f"{root}/t")
    R.write_raw_zone(df.limit(0), f"{root}/empty")
    flat = R.read_footers(spark, f"{root}/t")
    assert flat.columns == ["id", "comments", "none"]
    counts = P.null_counts(flat)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(comments), COUNT(none)]" in plan
    assert {tuple(r) for r in counts.collect()} == {("id", 0, 300), ("comments", 100, 300), ("none", 300, 300)}
    assert {tuple(r) for r in P.null_counts(R.read_footers(spark, f"{root}/empty")).collect()} == {("id", 0, 0), ("comments", 0, 0), ("none", 0, 0)}
    # a filter needs the rows; the same frame then scans
    assert flat.filter("comments IS NULL").count() == 100
    # the reader chosen for other tables is as before
    assert "BatchScan" not in spark.read.parquet(f"{root}/t").groupBy().count()._jdf.queryExecution().executedPlan().toString()
