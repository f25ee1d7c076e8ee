"""Session helpers: configuration for scale, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting handles one hot key holding a
# large share of the rows (e.g. one listing with a third of all reviews).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot does not compile methods over 8000 bytes of bytecode: a wide
    # projection of parsing expressions would then run interpreted inside one
    # whole-stage method.  Above this size Spark splits the stage instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "lodgespark", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied.

    On a cluster, leave ``master`` unset and let spark-submit decide; the
    shuffle partition count then stays at the cluster's setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def split_large_stages(spark: SparkSession) -> None:
    """Hold the session to the method size that HotSpot compiles (see ``SCALE_CONF``), also where it was not made
    by ``build_session``; a smaller limit of its own stays.  Read when a plan runs, so it is set for the session."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > int(SCALE_CONF[limit]):
        spark.conf.set(limit, SCALE_CONF[limit])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as it is written there.

    On a cluster this is set by the operator to shared storage.  Only where
    it is unset and everything runs in one process (tests) do we create one
    of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            # a machine-local folder is lost with its executor: on a cluster
            # the shared folder must be named by the operator
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder (e.g. on HDFS or S3)")
        d = tempfile.mkdtemp(prefix="lodgespark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def clean_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder handed out so far (at the end of a run, when no frame reads them any more)."""
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
