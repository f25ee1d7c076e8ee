"""Incremental ingest: files derived from the test tables land in two waves;
the second run picks up only the new files (exactly once)."""

from pyspark.sql import functions as F

from lodgespark import fixtures as FX
from lodgespark.session import scratch_path
from lodgespark.sources.raw import write_csv_gz
from lodgespark.streaming.ingest import run_ingest
from tests.conftest import SF_SMALL


def test_incremental_ingest_is_exactly_once(spark):
    reviews = FX.reviews_raw_from_lineitem(FX.read_table(spark, SF_SMALL, "lineitem"))
    first = reviews.filter(F.col("reviewer_id").cast("long") % 2 == 0)
    second = reviews.filter(F.col("reviewer_id").cast("long") % 2 == 1)
    root = scratch_path(spark, "stream-test")
    landing, out, ckpt = f"{root}/landing", f"{root}/raw/reviews", f"{root}/ckpt"
    write_csv_gz(first, f"{landing}/wave1")
    n1 = run_ingest(spark, f"{landing}/*", reviews.columns, out, "reviews", ckpt)
    assert n1 == first.count()
    write_csv_gz(second, f"{landing}/wave2")
    n2 = run_ingest(spark, f"{landing}/*", reviews.columns, out, "reviews", ckpt)
    assert n2 == reviews.count()
    # a rerun with nothing new adds nothing
    assert run_ingest(spark, f"{landing}/*", reviews.columns, out, "reviews", ckpt) == n2
    got = spark.read.parquet(out).select(F.col("id").cast("long").alias("id")).distinct().count()
    assert got == reviews.select("id").distinct().count()
