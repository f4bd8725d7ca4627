"""Structured Streaming (ST1–ST5).

* ``start_bronze_stream`` (ST1): topic → parse → append to Bronze, stateless;
  the same parse as the batch path. Progress and exactly-once file output
  come from the checkpoint and the file sink's log. Rejected messages go to
  the dead-letter table (``<bronze>_dlq`` unless a path is given) through a second
  query on the same source, so that each output has a log of its own.
* ``event_time`` / watermark (ST2): declared on the event-time column. A
  stateless append keeps late rows (ST3) — the watermark only matters for
  the stateful de-dup below.
* ``catch_up`` (ST4): drain everything available (``availableNow``), then a
  batch Silver over the accumulated Bronze.
* ``start_dedup_stream`` (ST5): first event per key with bounded state
  (``dropDuplicatesWithinWatermark``); events later than the watermark are
  dropped, and the drop count shows up in the query progress.
* ``start_latest_wins_stream`` (ST5, latest-wins variant): each micro-batch
  is de-duplicated with the batch operator and upserted by surrogate key
  into the touched Silver dates. Re-running a batch after a failure rewrites
  the same rows, so the sink is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.manifest import Manifest
from stratum.operators.parsing import parse_events
from stratum.operators.silver import quality_filter, silver_project
from stratum.sinks.tables import upsert_by_key, write_silver
from stratum.sources.events import stream_file_topic


def with_event_time(df: DataFrame, manifest: Manifest, column: str = "event_time") -> DataFrame:
    """ST2: ``event_time`` (a session-zone timestamp, as watermarks need) and
    a watermark ``watermark_interval_seconds`` behind the newest event."""
    return (df.withColumn(column, F.col(manifest.event_ts_col).cast("timestamp"))
            .withWatermark(column, f"{manifest.watermark_interval_seconds} seconds"))


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "10 seconds")


def start_bronze_stream(spark: SparkSession, manifest: Manifest, topic: DataFrame | str, bronze_path: str,
                        checkpoint: str, dlq_path: str | None = None, available_now: bool = False,
                        interval: str | None = None) -> list[StreamingQuery]:
    """ST1: continuous Bronze append. Returns the running queries."""
    if isinstance(topic, str):
        topic = stream_file_topic(spark, topic)
    parsed = parse_events(topic, manifest)
    queries = [_trigger(parsed.rows.writeStream.format("parquet").outputMode("append")
                        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/bronze"),
                        available_now, interval).start(bronze_path)]
    queries.append(_trigger(parsed.rejects.writeStream.format("parquet").outputMode("append")
                            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/dlq"),
                            available_now, interval).start(dlq_path or f"{bronze_path.rstrip('/')}_dlq"))
    return queries


def catch_up(spark: SparkSession, manifest: Manifest, topic_path: str, warehouse: str,
             checkpoint: str) -> DataFrame:
    """ST4: drain the topic into Bronze (``availableNow``), then rebuild
    Silver over all accumulated Bronze with the batch operator."""
    from stratum.operators.silver import silver
    from stratum.sinks.tables import layer_path

    bronze_path = layer_path(warehouse, manifest.bronze_table)
    for q in start_bronze_stream(spark, manifest, topic_path, bronze_path, checkpoint,
                                 dlq_path=layer_path(warehouse, "dlq." + manifest.name),
                                 available_now=True):
        q.awaitTermination()
    out = silver(spark.read.parquet(bronze_path), manifest)
    write_silver(out, manifest, warehouse, full=True)
    return spark.read.parquet(layer_path(warehouse, manifest.silver_table))


def dedup_stream(parsed_rows: DataFrame, manifest: Manifest) -> DataFrame:
    """ST5 as a transformation: quality filters, then the first event per
    de-dup key within the watermark, projected to Silver."""
    rows = with_event_time(quality_filter(parsed_rows, manifest.quality_filters), manifest)
    first = rows.dropDuplicatesWithinWatermark(list(manifest.dedup_key))
    return silver_project(first.drop("event_time"), manifest)


def start_dedup_stream(spark: SparkSession, manifest: Manifest, topic: DataFrame | str, silver_path: str,
                       checkpoint: str, available_now: bool = False,
                       interval: str | None = None) -> StreamingQuery:
    """ST5: streaming Silver with bounded de-dup state (RocksDB-backed when
    ``spark.sql.streaming.stateStore.providerClass`` says so)."""
    if isinstance(topic, str):
        topic = stream_file_topic(spark, topic)
    out = dedup_stream(parse_events(topic, manifest).rows, manifest)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .partitionBy(manifest.partition_date_col)
              .option("checkpointLocation", f"{checkpoint.rstrip('/')}/silver"))
    return _trigger(writer, available_now, interval).start(silver_path)


def start_latest_wins_stream(spark: SparkSession, manifest: Manifest, topic: DataFrame | str, silver_path: str,
                             checkpoint: str, available_now: bool = False,
                             interval: str | None = None) -> StreamingQuery:
    """ST5, latest wins: ``foreachBatch`` → batch Silver of the micro-batch →
    upsert by surrogate key into Silver (only the dates it touches; if the date is not
    part of the key, also those that hold an older copy)."""
    from stratum.operators.silver import silver
    from stratum.plans.pipeline import date_follows_key

    moves = not date_follows_key(manifest, manifest.surrogate_key_fields)
    if isinstance(topic, str):
        topic = stream_file_topic(spark, topic)
    rows = parse_events(topic, manifest).rows

    def merge(batch: DataFrame, _batch_id: int) -> None:
        upsert_by_key(batch.sparkSession, silver_path, silver(batch, manifest),
                      manifest.resolved_surrogate_key_name, manifest.partition_date_col, moves=moves)

    writer = (rows.writeStream.foreachBatch(merge)
              .option("checkpointLocation", f"{checkpoint.rstrip('/')}/silver_latest"))
    return _trigger(writer, available_now, interval).start()
