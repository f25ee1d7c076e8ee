"""Refreshes that cannot lose the table they replace.

A zone (or a single table) is refreshed by writing a new folder beside the
current one, checking its row counts from the files, and only then naming it
in ``_current``.  Readers resolve that name.  A job that dies before the last
step leaves the old rows readable; what it wrote is never seen and can be
removed by ``drop_old_versions``.

The pointer is the name of an empty file, ``<number>~<version>``, and the
highest name holds.  Creating a file is atomic on HDFS and on object stores,
where renaming over an existing file is not; of two refreshes that finish
together one holds for every reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodgespark.session import delete_path

POINTERS = "_current"
VERSION_PREFIX = "v-"


class RefreshError(RuntimeError):
    """The files of a new version do not hold the rows that were counted while writing it."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of the versions that were switched to, oldest first."""
    return [f"{root}/{n.split('~', 1)[1]}" for n in _names(spark, f"{root}/{POINTERS}") if "~" in n]


def current(spark: SparkSession, root: str) -> str:
    """The folder to read: the version switched to last, or ``root`` itself
    where nothing was ever refreshed this way."""
    return (versions(spark, root) or [root])[-1]


def refresh(spark: SparkSession, root: str, write: Callable[[str], Mapping[str, int]],
            keep: int | None = None, may_be_empty: bool = False) -> dict[str, int]:
    """Write a new version and switch to it.

    ``write(folder)`` fills the folder and returns the rows it wrote by
    subfolder ('' for the folder itself).  Every count is compared with the
    files (Parquet answers from its footers).  A write that raises, counts that
    differ and, unless ``may_be_empty``, a table without rows leave the old
    version current.  With ``keep`` only so many
    versions stay afterwards; a reader that planned on an older one needs it
    until it is done.  Returns the counts."""
    name = f"{VERSION_PREFIX}{uuid.uuid4().hex}"
    counts = dict(write(f"{root}/{name}"))
    for sub, n in counts.items():
        got = spark.read.parquet(f"{root}/{name}/{sub}").agg(F.count(F.lit(1))).first()[0]
        if got != n:
            raise RefreshError(f"{root}: {sub or 'table'} has {got} rows in its files, {n} were written")
        if not n and not may_be_empty:
            raise RefreshError(f"{root}: {sub or 'table'} has no rows")
    switch(spark, root, name)
    if keep:
        drop_old_versions(spark, root, keep)
    return counts


def switch(spark: SparkSession, root: str, name: str) -> None:
    """Make version ``name`` the one that readers resolve."""
    last = (_names(spark, f"{root}/{POINTERS}") or ["0"])[-1]
    fs, p = _fs(spark, f"{root}/{POINTERS}/{int(last.split('~')[0]) + 1:012d}~{name}")
    fs.create(p, False).close()


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2, unfinished: bool = False) -> list[str]:
    """Delete all but the last ``keep`` versions; with ``unfinished`` also the
    folders of refreshes that never switched (only where none is running).
    A version's pointer goes first.  Returns the names deleted."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    pointers = [n for n in _names(spark, f"{root}/{POINTERS}") if "~" in n]
    stay = {n.split("~", 1)[1] for n in pointers[-keep:]}
    gone = [n for n in pointers[:-keep] if n.split("~", 1)[1] not in stay]
    for n in gone:
        delete_path(spark, f"{root}/{POINTERS}/{n}")
    known = {n.split("~", 1)[1] for n in pointers}
    names = [n.split("~", 1)[1] for n in gone]
    if unfinished:
        names += [n for n in _names(spark, root) if n.startswith(VERSION_PREFIX) and n not in known]
    for n in names:
        delete_path(spark, f"{root}/{n}")
    return names
