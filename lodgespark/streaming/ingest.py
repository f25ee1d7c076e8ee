"""Incremental raw-zone ingest.

The batch ingest reads a file in fixed-size chunks and inserts each one.  The
Spark form is a file-source stream: every new file in the landing folder is
read with the all-text schema, its missing-value tokens normalised, and
appended to the raw zone.  ``availableNow`` processes what has landed and
stops, so the same code serves a scheduled batch and a continuous feed.  The
checkpoint (in the shared checkpoint folder) records which files are done:
after a lost executor or a killed job, a rerun resumes without duplicating
or losing rows (the Parquet file sink is exactly-once).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodgespark.operators.cleaning import normalize_null_tokens
from lodgespark.session import checkpoint_root
from lodgespark.sources.raw import all_text_schema


def raw_csv_stream(spark: SparkSession, landing: str, columns: Iterable[str],
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the rows of the CSV files landing in ``landing``."""
    reader = (spark.readStream.schema(all_text_schema(columns)).option("header", True)
              .option("multiLine", True).option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return normalize_null_tokens(reader.csv(landing)).withColumn("_ingested_at", F.current_timestamp())


def ingest_stream(spark: SparkSession, landing: str, columns: Iterable[str], raw_path: str,
                  name: str, checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append every landed file to the raw zone table at ``raw_path``."""
    ckpt = checkpoint or f"{checkpoint_root(spark)}/ingest-{name}"
    w = (raw_csv_stream(spark, landing, columns, max_files_per_trigger).writeStream
         .format("parquet").option("checkpointLocation", ckpt).outputMode("append").queryName(f"ingest_{name}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(raw_path)


def run_ingest(spark: SparkSession, landing: str, columns: Iterable[str], raw_path: str, name: str,
               checkpoint: str | None = None) -> int:
    """Process everything that has landed, wait, and return rows now in the table."""
    q = ingest_stream(spark, landing, columns, raw_path, name, checkpoint)
    q.awaitTermination()
    return spark.read.parquet(raw_path).count()
