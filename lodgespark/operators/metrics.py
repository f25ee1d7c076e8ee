"""Run metrics as a table, and the log that keeps them over runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "stage string, table string, metric string, value double"
STAGES = ("ingest", "transform", "publish")


def metrics_frame(spark, records: list[dict]) -> DataFrame:
    """Metrics as a DataFrame: (stage, table, metric, value) with value as double."""
    rows = [(r["stage"], r["table"], r["metric"], None if r["value"] is None else float(r["value"]))
            for r in records]
    return spark.createDataFrame(rows, SCHEMA)


def ingest_records(report: Iterable[tuple]) -> list[dict]:
    """Metrics of an ingest report, (table, rows, rejected, status, ...)."""
    out = []
    for table, rows, rejected, status, *_ in report:
        for metric, value in (("rows_in", rows + rejected), ("rows_rejected", rejected), ("rows_out", rows),
                              ("failed", int(status != "OK"))):
            out.append({"stage": "ingest", "table": table, "metric": metric, "value": value})
    return out


def publish_records(report: Iterable[tuple]) -> list[dict]:
    """Metrics of a publish report, (table, outcome, rows): rows in, published,
    set aside, and set aside by each rule."""
    report = [tuple(r) for r in report]
    out = []
    for table in sorted({t for t, _, _ in report}):
        mine = {rule: n for t, rule, n in report if t == table}
        published = mine.pop("published", 0)
        values = {"rows_in": published + sum(mine.values()), "rows_published": published, "rows_set_aside": sum(mine.values())}
        values |= {f"set_aside:{rule}": n for rule, n in sorted(mine.items())}
        out += [{"stage": "publish", "table": table, "metric": m, "value": v} for m, v in values.items()]
    return out


def append_run_log(spark: SparkSession, log_root: str, run_id: str, stage: str, records: list[dict]) -> None:
    """Append one stage of one run.  Each has a folder of its own, so runs do
    not touch each other's rows and a stage that is run again replaces its
    own; the few rows of a stage are one file."""
    if not run_id or set(run_id) & set("/=%") or stage not in STAGES:
        raise ValueError(f"run id {run_id!r} or stage {stage!r} cannot name a folder of the log")
    (metrics_frame(spark, records).drop("stage").withColumn("logged_at", F.current_timestamp()).coalesce(1)
        .write.mode("overwrite").parquet(f"{log_root}/run_id={run_id}/stage={stage}"))


def read_run_log(spark: SparkSession, log_root: str) -> DataFrame:
    """(run_id, stage, table, metric, value, logged_at) of all runs."""
    schema = "table string, metric string, value double, logged_at timestamp, run_id string, stage string"
    return spark.read.schema(schema).parquet(log_root).select("run_id", "stage", "table", "metric", "value", "logged_at")


def unbalanced_runs(log: DataFrame) -> DataFrame:
    """(run_id, stage, table, missing) where the rows that left a stage do not
    sum to those that came in; empty when every row is accounted for."""
    leaving = ["rows_out", "rows_rejected", "duplicates_dropped", "rows_published", "rows_set_aside"]
    flow = log.filter(F.col("metric").isin("rows_in", *leaving))
    sums = flow.groupBy("run_id", "stage", "table").agg(
        F.sum(F.when(F.col("metric") == "rows_in", F.col("value"))).alias("came"),
        F.sum(F.when(F.col("metric") != "rows_in", F.col("value"))).alias("left"))
    return sums.filter(F.col("came").isNotNull()).select("run_id", "stage", "table", (F.col("came") - F.coalesce("left", F.lit(0.0))).alias("missing")) \
               .filter("missing <> 0")
