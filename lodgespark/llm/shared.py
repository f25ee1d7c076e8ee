"""Helpers of the text operators: shared scratch tables and row keys."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodgespark.session import checkpoint_root

#: A run of white space as the contracts define it: space, tab, line feed, vertical tab, form feed, return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: The runs that differ from one plain space (replacing only these gives the same text, with fewer matches).
SPACE_RUN_TO_CHANGE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so neither a
    lost executor nor a second use computes `df` again.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a frame made by `stored`, once nothing reads it."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def ship_package() -> None:
    """Let the Python workers import this package: once a session, Spark hands a zip of its modules to the executors.

    Worker state (compressors, tries) then lives in the imported modules and
    is kept from task to task.
    """
    sc = SparkSession.active().sparkContext
    if getattr(sc, "_ships_lodgespark", False):
        return
    root = Path(__file__).resolve().parent.parent
    file = Path(tempfile.mkdtemp(prefix="lodgespark-code-")) / "lodgespark_modules.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(str(file))
    sc._ships_lodgespark = True


def one_space(text: Column) -> Column:
    """The text (null: empty) with every white-space run as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN_TO_CHANGE, " ")


def fold(key: Column, mod: int) -> Column:
    """crc32 of a key as text, modulo `mod`: the folds of the contracts."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(mod))


def hex64(value: Column) -> Column:
    """A 64-bit number as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
