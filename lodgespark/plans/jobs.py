"""The three jobs of the pipeline, zone to zone.

* ingest: raw text files -> raw zone (Parquet, all text, overwrite).
* transform: raw zone -> clean zone; the monthly summary is computed from the
  calendar as written, so the calendar's deduplication is not run twice and
  the summary's lineage starts at a stored table.
* publish: clean zone -> serving zone, after the quality checks.

Each write is an overwrite of a whole table (idempotent: a rerun after a lost
executor or a failed job gives the same result).  ``refresh_clean_zone``,
``refresh_serving_zone`` and ``ingest_job(keep=...)`` write a new version beside the
current one instead and switch to it when it is complete (``sources.versions``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodgespark.operators import quality as Q
from lodgespark.operators.cleaning import ORDINAL
from lodgespark.operators.quantiles import exact_quantiles
from lodgespark.operators.summaries import calendar_monthly_summary
from lodgespark.plans.transform import transform_calendar, transform_listings, transform_reviews
from lodgespark.session import delete_path, split_large_stages
from lodgespark.sources import raw as R
from lodgespark.sources import versions as V
from lodgespark.sources import zones as Z


class IngestError(RuntimeError):
    """At least one table could not be ingested; ``status`` has the report's rows."""

    def __init__(self, status: list[tuple]):
        super().__init__("; ".join(f"{t}: {e or 'no rows'}" for t, _, _, s, e in status if s != "OK"))
        self.status = status


def ingest_job(spark: SparkSession, files: Mapping[str, tuple[str, list[str] | None]], raw_root: str,
               partitions: int | None = None, strict: bool = False, keep: int | None = None) -> DataFrame:
    """``files``: table -> (CSV path, wanted columns; None: all of the header).  Each table is a full
    refresh of its raw-zone folder: well-formed and rejected rows are stored
    once and read back apart by ``sources.raw.read_raw_zone``.  A table whose
    files cannot be read does not stop the others; the result is (table_name,
    rows, rejected, status, error) with status 'FALLO' for a table that failed
    or is empty.  ``strict`` raises ``IngestError`` at the end in that case.
    With ``keep`` each table is refreshed as a new version, and so many stay;
    a failed or empty one leaves the rows of the last good one current."""
    def store(name: str, path: str, columns: list[str] | None) -> tuple[int, int]:
        df = R.scan_flagged(spark, path, columns or R.csv_header(spark, path))
        if keep is None:
            return R.write_flagged(df, f"{raw_root}/{name}", partitions)
        got: list[tuple[int, int]] = []

        def write(folder: str) -> dict[str, int]:
            got.append(R.write_flagged(df, folder, partitions))
            if not got[0][0]:
                raise V.RefreshError("no well-formed rows")
            return {"": sum(got[0])}
        V.refresh(spark, f"{raw_root}/{name}", write, keep)
        return got[0]

    split_large_stages(spark)
    out = []
    for name, (path, columns) in files.items():
        try:
            rows, bad = store(name, path, columns)
            out.append((name, rows, bad, "OK" if rows else "FALLO", None))
        except Exception as e:  # noqa: BLE001 - the failure and its cause are part of the report
            out.append((name, 0, 0, "FALLO", str(e).splitlines()[0][:500]))
    if strict and any(r[3] != "OK" for r in out):
        raise IngestError(out)
    return spark.createDataFrame(out, "table_name string, rows bigint, rejected bigint, status string, error string")


def _run_transform(raw: Mapping[str, DataFrame], clean_root: str,
                   orders: Mapping[str, list[Column]] | None = None,
                   metrics: bool = True) -> tuple[dict[str, int], list[dict]]:
    """Write the clean zone; row counts and listing measures are observed
    while each table is written (no extra pass over the data).  With
    ``metrics`` the input counts and exact price quartiles are added (their
    own small jobs: a Parquet count and a one-row aggregate).

    The three tables are independent, so their writes are submitted as
    concurrent jobs (one driver thread each): the scheduler fills the
    executors left idle by one job's last tasks with another job's tasks.
    The summary follows the calendar."""
    orders = orders or {}
    steps = {"listings": transform_listings, "reviews": transform_reviews, "calendar": transform_calendar}

    def write_one(name: str) -> tuple[int, list[dict]]:
        recs: list[dict] = []

        def rec(metric, value):
            recs.append({"stage": "transform", "table": name, "metric": metric, "value": value})

        out = steps[name](raw[name], orders.get(name))
        extra = []
        if name == "listings":
            extra = [F.sum(F.col("price_clean").isNull().cast("long")).alias("null_prices"),
                     F.avg("n_amenities").alias("mean_n_amenities")]
        obs = Observation(f"clean_{name}")
        path = f"{clean_root}/{name}_clean"
        out.observe(obs, F.count(F.lit(1)).alias("rows"), *extra).write.mode("overwrite").parquet(path)
        m = obs.get
        if metrics:
            rows_in = raw[name].count()
            rec("rows_in", rows_in)
            rec("rows_out", m["rows"])
            rec("duplicates_dropped", rows_in - m["rows"])
            rec("columns_in", len([c for c in raw[name].columns if c != ORDINAL]))
            rec("columns_out", len(out.columns))
            for k in ("null_prices", "mean_n_amenities"):
                if k in m:
                    rec(k, m[k])
            if name == "listings":
                # exact quartiles need their own aggregate (one row)
                lst = out.sparkSession.read.parquet(path)
                q = exact_quantiles(lst, "price_clean", [0.25, 0.5, 0.75]).first()
                for label, v in zip(["price_q25", "price_median", "price_q75"], q):
                    rec(label, v)
        return int(m["rows"]), recs

    names = [n for n in steps if n in raw]
    with ThreadPoolExecutor(max_workers=max(len(names), 1)) as pool:
        done = dict(zip(names, pool.map(write_one, names)))
    counts = {n: done[n][0] for n in names}
    records = [r for n in names for r in done[n][1]]
    if "calendar" in raw:
        spark = raw["calendar"].sparkSession
        cal = spark.read.parquet(f"{clean_root}/calendar_clean")
        obs = Z.write_table(calendar_monthly_summary(cal), f"{clean_root}/calendar_summary_clean")
        counts["calendar_summary"] = int(obs.get["rows"])
        if metrics:
            records.append({"stage": "transform", "table": "calendar_summary", "metric": "rows_out",
                            "value": counts["calendar_summary"]})
    return counts, records


def transform_job(raw: Mapping[str, DataFrame], clean_root: str,
                  orders: Mapping[str, list[Column]] | None = None) -> dict[str, int]:
    """Clean every present raw table into the clean zone; rows per table."""
    return _run_transform(raw, clean_root, orders, metrics=False)[0]


def transform_job_metrics(raw: Mapping[str, DataFrame], clean_root: str,
                          orders: Mapping[str, list[Column]] | None = None) -> DataFrame:
    """Run the transform job and return its run metrics as a DataFrame
    (stage, table, metric, value)."""
    from lodgespark.operators.metrics import metrics_frame
    spark = next(iter(raw.values())).sparkSession
    return metrics_frame(spark, _run_transform(raw, clean_root, orders)[1])


def refresh_clean_zone(spark: SparkSession, raw: Mapping[str, DataFrame], clean_root: str,
                       orders: Mapping[str, list[Column]] | None = None, keep: int = 2) -> tuple[dict[str, int], list[dict]]:
    """The transform job as a refresh of the whole clean zone: its tables
    change together, when all of them are written and counted.  Returns the
    rows per table and the run's metrics."""
    records: list[dict] = []

    def write(folder: str) -> dict[str, int]:
        counts, recs = _run_transform(raw, folder, orders)
        records.extend(recs)
        return {f"{n}_clean": c for n, c in counts.items()}
    counts = V.refresh(spark, clean_root, write, keep)
    return {n.removesuffix("_clean"): c for n, c in counts.items()}, records


def refresh_serving_zone(spark: SparkSession, clean_root: str, serving_root: str, policy: str = "fail",
                         keep: int = 2) -> list[tuple[str, str, int]]:
    """The publish job as a refresh of the whole serving zone, with the rows
    set aside beside the tables of their version.  Returns publish_job's rows."""
    report: list[tuple[str, str, int]] = []

    def write(folder: str) -> dict[str, int]:
        report.extend(tuple(r) for r in publish_job(spark, clean_root, folder, policy).collect())
        return {t: sum(n for u, o, n in report if u == t and o == "published") for t in {r[0] for r in report}}
    V.refresh(spark, serving_root, write, keep)
    return report


def read_clean(spark: SparkSession, clean_root: str, names: Iterable[str] = Z.PUBLISH_ORDER) -> dict[str, DataFrame]:
    """The clean tables that are present."""
    clean_root = V.current(spark, clean_root)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = {n: jvm.org.apache.hadoop.fs.Path(f"{clean_root}/{n}_clean") for n in names}
    return {n: spark.read.parquet(f"{clean_root}/{n}_clean") for n, p in at.items() if p.getFileSystem(conf).exists(p)}


def publish_job(spark: SparkSession, clean_root: str, serving_root: str, policy: str = "fail",
                jdbc: Mapping[str, str] | None = None, tables: Iterable[str] | None = None) -> DataFrame:
    """Apply every rule of the serving tables to the clean tables that are
    present, then overwrite the serving tables, parents first.

    Each row gets the first rule it breaks (types, NOT NULL, reference, key;
    ``quality.first_violation``) and is stored once with it.
    ``policy='fail'`` stops on any violation before anything is published;
    ``'quarantine'`` puts those rows aside under ``_quarantine`` and publishes
    the rest.  The result is (table_name, outcome, rows) with one row per
    table and outcome, 'published' or the rule; per table they sum to the rows
    that came in.  Reviews and calendar rows refer to the published listings.
    ``tables`` limits what is published to some of the tables (the listings
    are checked with them, as parents).  Of equal keys the first row in the
    clean zone's files stays.
    """
    split_large_stages(spark)
    clean = read_clean(spark, clean_root)
    names = [n for n in Z.PUBLISH_ORDER if n in clean and (tables is None or n in tables or (n == "listings" and {"reviews", "calendar"} & set(tables)))]
    root = f"{serving_root}/_checked"

    def check(name: str) -> list[tuple[str, str, int]]:
        df = Z.SERVING_PROJECTIONS[name](clean[name]).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        parents = {}
        if name in ("reviews", "calendar") and "listings" in names:
            known = spark.read.parquet(f"{root}/listings")
            parents = {"listing_id": (known.filter(F.col("violation").isNull()), "id")}
        Q.first_violation(df, Z.SERVING_SCHEMAS[name], Z.SERVING_KEYS[name], Z.SERVING_NOT_NULL[name], parents, place=("__file", "__row")) \
            .drop("__file", "__row").write.mode("overwrite").parquet(f"{root}/{name}")
        got = spark.read.parquet(f"{root}/{name}").groupBy("violation").agg(F.count(F.lit(1)).alias("n")).collect()
        return [(name, r["violation"] or "published", int(r["n"])) for r in got]

    report = [r for n in names[:1] if n == "listings" for r in check(n)]  # its rows are the others' parents
    rest = [n for n in names if n != "listings"]
    with ThreadPoolExecutor(max_workers=max(len(rest), 1)) as pool:
        report += [r for part in pool.map(check, rest) for r in part]
    names = [n for n in names if tables is None or n in tables]
    report = [r for r in report if r[0] in names]
    broken = [r for r in report if r[1] != "published"]
    if policy == "fail" and broken:
        raise ValueError("; ".join(f"{t}: {n} rows break {rule}" for t, rule, n in sorted(broken)))
    stored = {n: spark.read.parquet(f"{root}/{n}") for n in names}

    def set_aside(name: str) -> None:
        stored[name].filter(F.col("violation").isNotNull()).write.mode("overwrite").parquet(f"{serving_root}/_quarantine/{name}")

    published = Z.publish_all({n: df.filter(F.col("violation").isNull()).drop("violation") for n, df in stored.items()},
                              serving_root, jdbc=jdbc)
    with ThreadPoolExecutor(max_workers=max(len(broken), 1)) as pool:
        list(pool.map(set_aside, sorted({t for t, _, _ in broken} & set(names))))
    for name in names:
        if published[name] != sum(n for t, rule, n in report if t == name and rule == "published"):
            raise RuntimeError(f"{name}: rows published differ from rows checked")
    delete_path(spark, root)
    return spark.createDataFrame(sorted(report), "table_name string, outcome string, rows bigint")
