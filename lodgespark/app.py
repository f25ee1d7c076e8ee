"""Command line of the jobs, for spark-submit:

    spark-submit --py-files lodgespark.zip lodgespark/app.py ingest --landing DIR --raw DIR
    spark-submit --py-files lodgespark.zip lodgespark/app.py transform --raw DIR --clean DIR
    spark-submit --py-files lodgespark.zip lodgespark/app.py publish --clean DIR --serving DIR --policy quarantine

Every job refreshes its zone as a new version (``sources.versions``) and, with
``--log DIR``, appends its metrics to the run log.  Exit codes: 0 done, 1 the
job failed or a table could not be ingested, 2 wrong arguments.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid

if __package__ in (None, ""):  # started as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from lodgespark.operators import metrics as M  # noqa: E402
from lodgespark.plans import jobs as J  # noqa: E402
from lodgespark.session import build_session  # noqa: E402
from lodgespark.sources import raw as R  # noqa: E402
from lodgespark.sources import versions as V  # noqa: E402

TABLES = ("listings", "reviews", "calendar")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodgespark", description="Jobs of the rental tables, zone to zone.")
    p.add_argument("--master", help="only for local runs; on a cluster spark-submit names it")
    jobs = p.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="CSV files -> raw zone")
    ingest.add_argument("--landing", required=True, help="folder with <table>.csv, <table>.csv.gz or a folder <table>")
    ingest.add_argument("--raw", required=True)
    ingest.add_argument("--partitions", type=int, help="spread the rows of few large files")
    transform = jobs.add_parser("transform", help="raw zone -> clean zone")
    transform.add_argument("--raw", required=True)
    transform.add_argument("--clean", required=True)
    publish = jobs.add_parser("publish", help="clean zone -> serving zone")
    publish.add_argument("--clean", required=True)
    publish.add_argument("--serving", required=True)
    publish.add_argument("--policy", choices=("fail", "quarantine"), default="fail")
    ingest.add_argument("--tables", nargs="+", choices=TABLES, default=list(TABLES))
    for job in (ingest, transform, publish):
        job.add_argument("--log", help="folder of the run log")
        job.add_argument("--run-id", default=None, help="default: a new one")
        job.add_argument("--keep", type=int, default=2, help="versions that stay")
    return p


def _landing(spark: SparkSession, root: str, table: str) -> str:
    """The file or folder of a table; the plain name where there is none, so
    that the report names what is missing."""
    for name in (f"{table}.csv.gz", f"{table}.csv", table):
        fs, p = V._fs(spark, f"{root}/{name}")
        if fs.exists(p):
            return f"{root}/{name}"
    return f"{root}/{table}.csv"


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> tuple[list[dict], bool]:
    files = {t: (_landing(spark, args.landing, t), None) for t in args.tables}
    report = [tuple(r) for r in J.ingest_job(spark, files, args.raw, args.partitions, keep=args.keep).collect()]
    for table, rows, rejected, status, error in report:
        print(f"{table}: {status}, {rows} rows, {rejected} rejected{': ' + error if error else ''}")
    return M.ingest_records(report), all(r[3] == "OK" for r in report)


def run_transform(spark: SparkSession, args: argparse.Namespace) -> tuple[list[dict], bool]:
    raw = {t: R.read_raw_zone(spark, f"{args.raw}/{t}")[0] for t in TABLES}
    counts, records = J.refresh_clean_zone(spark, raw, args.clean, keep=args.keep)
    for table, n in counts.items():
        print(f"{table}: {n} rows")
    return records, True


def run_publish(spark: SparkSession, args: argparse.Namespace) -> tuple[list[dict], bool]:
    report = J.refresh_serving_zone(spark, args.clean, args.serving, args.policy, keep=args.keep)
    for table, outcome, n in report:
        print(f"{table}: {n} rows {outcome}")
    return M.publish_records(report), True


JOBS = {"ingest": run_ingest, "transform": run_transform, "publish": run_publish}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one job; the exit code."""
    try:
        args = parser().parse_args(argv)
        if args.keep < 1:
            parser().error("--keep must be at least 1")
    except SystemExit as e:
        return int(e.code or 0)
    session = spark or build_session(args.master, app=f"lodgespark-{args.job}")
    try:
        records, ok = JOBS[args.job](session, args)
        if args.log:
            M.append_run_log(session, args.log, args.run_id or uuid.uuid4().hex, args.job, records)
        return 0 if ok else 1
    except Exception as e:  # noqa: BLE001 - a job's failure is its exit code
        print(f"{args.job} failed: {str(e).splitlines()[0] if str(e) else type(e).__name__}", file=sys.stderr)
        return 1
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    sys.exit(main())
