"""Batch ledger of Bronze (SIL1, SNK4): which file holds which batch's rows of which date.

An index table beside Bronze: (file, ingestion_ts, date), a few rows per file. It is
brought up to date from the files that it does not know yet, which alone are read, and in
them only the event time and the ingestion time. After a batch, Silver reads the ledger for the
batch's dates and then only the Bronze files that hold rows of these dates: files
of other dates are not opened. Rows without a date have a ledger entry like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.manifest import Manifest
from stratum.sinks.tables import _exists, in_partitions, partition_values

LEDGER_SCHEMA = "file STRING, ingestion_ts TIMESTAMP_NTZ, date DATE"


def ledger_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}.ledger"


def partition_date(manifest: Manifest) -> Column:
    return F.expr(manifest.partition_date_expr).cast("date")


def update_ledger(spark: SparkSession, manifest: Manifest, bronze_path: str) -> DataFrame:
    """Add the files that the ledger lacks (of a batch, a stream or another writer); returns the entries of the files that exist."""
    path = ledger_path(bronze_path)
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(bronze_path)
              .select(F.col("path").alias("file")))  # a listing; no data is read
    known = spark.read.schema(LEDGER_SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LEDGER_SCHEMA)
    new = [r[0] for r in listed.join(known.select("file").distinct(), "file", "left_anti").collect()]  # names of new files
    if new:
        rows = spark.read.parquet(*new)
        entries = rows.select(F.col("_metadata.file_path").alias("file"), F.col("ingestion_ts").cast("timestamp_ntz").alias("ingestion_ts"),
                              partition_date(manifest).alias("date")).distinct()
        empty = spark.createDataFrame([(f,) for f in new], "file string").join(entries.select("file"), "file", "left_anti")
        blank = empty.select("file", F.lit(None).cast("timestamp_ntz").alias("ingestion_ts"), F.lit(None).cast("date").alias("date"))
        entries.unionByName(blank).coalesce(1).write.mode("append").parquet(path)
        known = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return known.join(listed, "file", "left_semi")


def files_of_batch_dates(spark: SparkSession, manifest: Manifest, bronze_path: str, run_ts) -> tuple[list, list[str]]:
    """The dates (NULL among them) that the batch stamped ``run_ts`` touched, and the files that hold rows of these dates."""
    ledger = update_ledger(spark, manifest, bronze_path)
    batch = ledger.where(F.col("ingestion_ts") == F.lit(run_ts).cast("timestamp_ntz"))
    dates = partition_values(batch, "date")
    if not dates:
        return [], []
    held = ledger.where(in_partitions("date", dates) & F.col("ingestion_ts").isNotNull())
    return dates, [r[0] for r in held.select("file").distinct().collect()]
