"""Registered queries that go through tables, topics and streams of their own (in ``queries/<name>``
below the shared folder), each over the whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import checks as ck
from stratum.operators import key_state, models, prefix, reconcile
from stratum.plans import bindings as b
from stratum.plans.bindings import table
from stratum.plans.catalog import register
from stratum.plans.queries import LINEITEM_FILTERS, ORDERS_SPLIT, query_folder
from stratum.plans.taxi import TripPlan
from stratum.sinks import tables
from stratum.sinks.compaction import compact
from stratum.sinks.publish import write_file_topic
from stratum.sources.events import read_numbered_topic
from stratum.streaming import late

# Fixed parameters of the registered queries.
BATCH_EVENTS = 500  # of a micro-batch of late_events
HALF_MONTH = ("2024-01-16", "2024-01-15")  # silver_incremental: end of the first batch, start of the second


@register("running_value")
def running_value(spark: SparkSession, d: str) -> DataFrame:
    """WN2 at the grain of the events: running total and number of every event."""
    rows = table(spark, d, "events").select("event_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    out = prefix.running_totals(rows, ["ts", "event_id"], {"running_cents": "cents", "number": F.lit(1).cast("long")}, query_folder(spark, "running_value"))
    return out.drop("cents")


@register("row_accounting_merged")
def row_accounting_merged(spark: SparkSession, d: str) -> DataFrame:
    """RC7 over three batches of line items, each of which leaves a state; the rows are read once."""
    path, rows = query_folder(spark, "row_accounting_merged"), table(spark, d, "lineitem")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")  # line numbers run from 1 to 7
    for i in range(3):
        part = rows.filter(F.col("l_partkey") % 3 == i)
        key_state.batch_state(part, f"part-{i}", LINEITEM_FILTERS, key).write.mode("append").parquet(path)
    return key_state.accounting(spark.read.schema(key_state.STATE_SCHEMA).parquet(path))


@register("late_events")
def late_events(spark: SparkSession, d: str) -> DataFrame:
    """ST3: the events in micro-batches, some of them hours behind, each with its watermark and whether it is late."""
    events = table(spark, d, "events")
    rows = events.select("event_id", F.expr(f"event_id div {BATCH_EVENTS}").alias("batch"),
                         F.expr("ts - make_dt_interval(0, CAST(user_id % 7 AS INT), 0, 0)").alias("happened"))
    return late.late_ledger(rows, "batch", "happened", TripPlan(spark, d).manifest.watermark_interval_seconds).withColumn(
        "watermark", F.col("watermark").cast("timestamp_ntz"))


@register("compacted")
def compacted(spark: SparkSession, d: str) -> DataFrame:
    """MT1: the events appended to a daily table in four parts, and its small files packed."""
    path = query_folder(spark, "compacted")
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    for i in range(4):
        events.filter(F.col("event_id") % 4 == i).write.mode("append").partitionBy("day").parquet(path)
    compact(spark, path, "day")
    return spark.read.parquet(path)


@register("upsert_moved")
def upsert_moved(spark: SparkSession, d: str) -> DataFrame:
    """UP1 with keys that change their partition, to and from NULL: a third of the orders moves by 400 days."""
    path = query_folder(spark, "upsert_moved/orders")
    year = lambda n: F.when(F.col("o_orderkey") % n != 0, F.year("o_orderdate")).cast("int")
    orders = table(spark, d, "orders")
    target = orders.withColumn("o_year", year(20))
    batch = (orders.filter(F.col("o_orderkey") % 3 == 0).withColumn("o_orderstatus", F.lit("M"))
             .withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 400 DAYS")).withColumn("o_year", year(15)))
    tables.drop_key_indexes(spark, path)
    for rows in (target, batch):
        tables.upsert_by_key(spark, path, rows, "o_orderkey", "o_year", moves=True)
    return tables.read_target(spark, path, target, "o_year")


@register("silver_incremental")
def silver_incremental(spark: SparkSession, d: str) -> DataFrame:
    """SIL1: two batches of events that share a day; after each, Silver takes the dates that the ledger names."""
    import datetime as dt

    from stratum.plans import pipeline

    p, warehouse, events = TripPlan(spark, d), query_folder(spark, "silver_incremental"), table(spark, d, "events")
    bound = lambda day: F.lit(day).cast("timestamp_ntz")
    first, second = events.filter(F.col("ts") < bound(HALF_MONTH[0])), events.filter(F.col("ts") >= bound(HALF_MONTH[1]))
    for hour, part in enumerate((first, second)):
        at = dt.datetime.fromisoformat(b.RUN_TS) + dt.timedelta(hours=hour)
        pipeline.run_bronze(spark, p.manifest, b.trip_topic(part, p.manifest), warehouse, ingestion_ts=at)
        pipeline.run_silver(spark, p.manifest, warehouse, at)
    return spark.read.parquet(tables.layer_path(warehouse, p.manifest.silver_table)).drop("ingestion_ts")


@register("published_hot")
def published_hot(spark: SparkSession, d: str) -> DataFrame:
    """SNK3 with one key on half of the messages: messages by key, and the ends of the hot key's restored order."""
    path = query_folder(spark, "published_hot")
    key = F.when(F.col("event_id") % 2 == 0, "hot").otherwise(F.col("user_id").cast("string"))
    write_file_topic(table(spark, d, "events").orderBy("event_id").select(key.alias("key"), F.col("event_id").cast("string").alias("value")), path)
    return read_numbered_topic(spark, path).groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"), F.min_by(F.col("value").cast("long"), "seq").alias("a"), F.max_by(F.col("value").cast("long"), "seq").alias("z")).select(
        "key", "messages", F.when(F.col("key") == "hot", F.col("a")).alias("first_id"), F.when(F.col("key") == "hot", F.col("z")).alias("last_id"))


@register("table_counts")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    """RC1 of tables by path: counts from the files' footers."""
    return reconcile.layer_counts(spark, {t: f"{d.rstrip('/')}/{t}.parquet" for t in ("customer", "orders", "lineitem", "events")})


@register("stream_run_metrics")
def stream_run_metrics(spark: SparkSession, d: str) -> DataFrame:
    """RC8, RC9: what the micro-batches of a Bronze stream report, and whether it may be trusted."""
    from stratum.streaming.bronze import start_bronze_stream
    from stratum.streaming.metrics import stream_metrics

    p, path = TripPlan(spark, d), query_folder(spark, "stream_run_metrics")
    write_file_topic(p.topic, f"{path}/topic")
    with stream_metrics(spark, p.manifest.name, p.manifest.topic, f"{path}/topic") as listener:
        rows, rejects = start_bronze_stream(spark, p.manifest, f"{path}/topic", f"{path}/bronze", f"{path}/checkpoint", available_now=True)
        rows.awaitTermination(), rejects.awaitTermination()
        listener.write(spark, rows, f"{path}/metrics")
    metrics = spark.read.schema(reconcile.METRICS_SCHEMA).parquet(f"{path}/metrics")
    trust = reconcile.metrics_trust(metrics, p.manifest.name, p.manifest.topic, f"{path}/topic").first()
    return metrics.agg(F.sum("events").alias("events"), F.sum("invalid").alias("invalid"), F.lit(trust.passed).alias("trusted"))


def _topic(spark: SparkSession, d: str, name: str) -> tuple[TripPlan, str]:
    p, path = TripPlan(spark, d), query_folder(spark, name)
    write_file_topic(p.topic, f"{path}/topic")
    return p, path


@register("dedup_stream")
def dedup_stream(spark: SparkSession, d: str) -> DataFrame:
    """ST2, ST5: Silver as a stream, first event per key within the watermark."""
    from stratum.streaming.bronze import start_dedup_stream

    p, path = _topic(spark, d, "dedup_stream")
    start_dedup_stream(spark, p.manifest, f"{path}/topic", f"{path}/silver", f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/silver").drop("ingestion_ts")


@register("latest_wins_stream")
def latest_wins_stream(spark: SparkSession, d: str) -> DataFrame:
    """ST5, latest wins: every micro-batch upserted into Silver."""
    from stratum.streaming.bronze import start_latest_wins_stream

    p, path = _topic(spark, d, "latest_wins_stream")
    start_latest_wins_stream(spark, p.manifest, f"{path}/topic", f"{path}/silver", f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/silver").drop("ingestion_ts")


@register("stream_catch_up")
def stream_catch_up(spark: SparkSession, d: str) -> DataFrame:
    """ST4: a topic drained into Bronze, then Silver over all of it."""
    from stratum.streaming.bronze import catch_up

    p, path = _topic(spark, d, "stream_catch_up")
    return catch_up(spark, p.manifest, f"{path}/topic", f"{path}/warehouse", f"{path}/checkpoint").drop("ingestion_ts")


@register("csv_zones")
def csv_zones(spark: SparkSession, d: str) -> DataFrame:
    """SRC6: the zone lookup as the CSV file that users have, read again."""
    from stratum.sources.tables import read_lookup

    path = query_folder(spark, "csv_zones")
    zones = TripPlan(spark, d).zones_csv
    zones.write.option("header", True).csv(path)
    return models.dim_locations(read_lookup(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in zones.schema.fields)))


@register("full_refresh")
def full_refresh(spark: SparkSession, d: str) -> DataFrame:
    """UP3: a table rebuilt from fewer rows, whose old partitions go."""
    path = query_folder(spark, "full_refresh")
    orders = table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    tables.full_refresh(orders, path, "o_year")
    tables.full_refresh(orders.filter(F.col("o_orderdate") >= F.lit(ORDERS_SPLIT[1]).cast("timestamp_ntz")), path, "o_year")
    return spark.read.parquet(path)


@register("latest_state_stream")
def latest_state_stream(spark: SparkSession, d: str) -> DataFrame:
    """ST5, latest wins by keyed state: what is not newer than the state of its key never reaches Silver."""
    from stratum.streaming.latest import start_latest_state_stream

    p, path = _topic(spark, d, "latest_state_stream")
    start_latest_state_stream(spark, p.manifest, f"{path}/topic", f"{path}/silver", f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/silver").drop("ingestion_ts")


@register("staging_tests")
def staging_tests(spark: SparkSession, d: str) -> DataFrame:
    """DT11: the generic test set of the staging model."""
    p = TripPlan(spark, d)
    return ck.run_checks(models.stg_generic(p.silver, p.manifest), ck.staging_checks(p.manifest), "stg_taxi")


@register("dataset_run")
def dataset_run(spark: SparkSession, d: str) -> DataFrame:
    """PL1: the generic run of a dataset, and the rows of its tables, read from their footers."""
    from stratum.plans import pipeline

    p, warehouse = TripPlan(spark, d), query_folder(spark, "dataset_run")
    return pipeline.run_dataset(spark, p.manifest, p.topic, warehouse, ingestion_ts=p.run_ts, dlq_max=1 << 60).counts
