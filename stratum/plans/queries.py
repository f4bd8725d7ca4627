"""Registered queries beyond the trip-pipeline nodes: one per operator of
SURVEY §2, each over the whole driver tables."""

from __future__ import annotations

import json
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import manifest as mf
from stratum.functions import minute_diff
from stratum.operators import checks as ck
from stratum.operators import models, parsing, reconcile, silver
from stratum.plans.bindings import table
from stratum.plans.catalog import register
from stratum.plans.taxi import TripPlan
from stratum.sinks.publish import dlq_path_of, publish, write_file_topic
from stratum.session import checkpoint_dir
from stratum.sinks.tables import incremental_rows, layer_path, merge_by_key, remove
from stratum.sinks.tables import upsert_by_key as upsert_by_key_sink
from stratum.sources.events import read_file_topic
from stratum.sources.tables import first_rows

# Fixed parameters of the registered queries.
LINEITEM_KEY = ("l_orderkey", "l_linenumber")
LINEITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey")
LINEITEM_FILTERS = ("l_quantity > 0", "l_discount <= 0.08", "l_shipdate >= DATE '1996-01-01'")
ORDERS_SPLIT = ("1999-01-01", "1998-01-01")  # target: before the first; batch: from the second on
FRESHNESS_NOW = "2024-02-01 12:00:00"
ROW_CAP = 1000
READY_ROWS = 5


@cache
def trip_json_schema() -> dict:
    with open(mf.DATASETS_DIR / "taxi.schema.json", encoding="utf-8") as fh:
        return json.load(fh)


# ---------------------------------------------------------------- sources
@register("scan_parquet")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    """SRC1: a whole Parquet table."""
    return table(spark, d, "lineitem")


@register("row_cap")
def row_cap(spark: SparkSession, d: str) -> DataFrame:
    """SRC2: the first N rows in key order."""
    return first_rows(table(spark, d, "lineitem"), ROW_CAP, LINEITEM_KEY + LINEITEM_ORDER)


# --------------------------------------------------------- topic / bronze
@register("encode_events")
def encode_events(spark: SparkSession, d: str) -> DataFrame:
    """SNK1+SNK2: trip rows → (key, JSON value)."""
    return TripPlan(spark, d).topic


@register("bronze_parse")
def bronze_parse(spark: SparkSession, d: str) -> DataFrame:
    """PRJ1–PRJ4: JSON topic → typed Bronze rows with ingestion time."""
    return TripPlan(spark, d).bronze


@register("schema_gate_valid")
def schema_gate_valid(spark: SparkSession, d: str) -> DataFrame:
    """QG1: messages passing the payload schema."""
    valid, _ = parsing.split_by_schema(TripPlan(spark, d).topic, trip_json_schema())
    return valid.select("key",
                        F.get_json_object("value", "$.tpep_pickup_datetime").alias("tpep_pickup_datetime"),
                        F.get_json_object("value", "$.total_amount").cast("double").alias("total_amount"))


@register("schema_gate_rejected")
def schema_gate_rejected(spark: SparkSession, d: str) -> DataFrame:
    """QG1: messages failing the payload schema, with the first error."""
    _, rejected = parsing.split_by_schema(TripPlan(spark, d).topic, trip_json_schema())
    return rejected.select("key", "error")


@register("surrogate_key")
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    """PRJ6: key hash of every Bronze row (NULL fields keep their slot)."""
    p = TripPlan(spark, d)
    b = p.bronze
    return b.select(silver.surrogate_key(p.manifest, b).alias("trip_id"), *p.manifest.surrogate_key_fields)


@register("quality_filter")
def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    """FLT1: Bronze rows passing every quality filter."""
    p = TripPlan(spark, d)
    return silver.quality_filter(p.bronze, p.manifest.quality_filters)


@register("silver_project")
def silver_project(spark: SparkSession, d: str) -> DataFrame:
    """PRJ5–PRJ7: rename/cast, key and partition date over all Bronze rows."""
    p = TripPlan(spark, d)
    return silver.silver_project(p.bronze, p.manifest)


@register("dedup_latest")
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    """DD1: one line item per (order, line number): the latest shipment."""
    return silver.dedup_latest(table(spark, d, "lineitem"), LINEITEM_KEY, LINEITEM_ORDER)


@register("rule_audit")
def rule_audit(spark: SparkSession, d: str) -> DataFrame:
    """QG3: rows failing each quality filter, and first-failing counts."""
    p = TripPlan(spark, d)
    return ck.rule_audit(p.bronze, p.manifest.quality_filters)


@register("derived_range_checks")
def derived_range_checks(spark: SparkSession, d: str) -> DataFrame:
    """QG4: range checks derived from the manifest's filters, run on Silver."""
    p = TripPlan(spark, d)
    return ck.run_row_checks(p.silver, ck.derived_range_checks(p.manifest), "silver")


# ------------------------------------------------------------------ staging
@register("stg_generic")
def stg_generic(spark: SparkSession, d: str) -> DataFrame:
    p = TripPlan(spark, d)
    return models.stg_generic(p.silver, p.manifest)


@register("stg_lookups")
def stg_lookups(spark: SparkSession, d: str) -> DataFrame:
    """PRJ10: the four staged lookups in one long table."""
    p = TripPlan(spark, d)
    z = p.dim_locations.select(F.lit("zones").alias("lookup"), F.col("location_id").alias("id"),
                               F.col("zone_name").alias("name"), F.col("borough").alias("attribute"))
    pay = p.dim_payment_types.select(F.lit("payment_types").alias("lookup"),
                                     F.col("payment_type_id").cast("bigint").alias("id"),
                                     F.col("payment_type_name").alias("name"),
                                     F.lit(None).cast("string").alias("attribute"))
    rate = p.dim_rate_codes.select(F.lit("rate_codes").alias("lookup"),
                                   F.col("rate_code_id").cast("bigint").alias("id"),
                                   F.col("rate_code_name").alias("name"),
                                   F.lit(None).cast("string").alias("attribute"))
    ven = p.dim_vendors.select(F.lit("vendors").alias("lookup"), F.col("vendor_id").alias("id"),
                               F.col("vendor_name").alias("name"), F.col("vendor_abbr").alias("attribute"))
    return z.unionByName(pay).unionByName(rate).unionByName(ven)


@register("dim_payment_types")
def dim_payment_types(spark: SparkSession, d: str) -> DataFrame:
    return TripPlan(spark, d).dim_payment_types


@register("dim_rate_codes")
def dim_rate_codes(spark: SparkSession, d: str) -> DataFrame:
    return TripPlan(spark, d).dim_rate_codes


@register("dim_vendors")
def dim_vendors(spark: SparkSession, d: str) -> DataFrame:
    return TripPlan(spark, d).dim_vendors


@register("duration_minutes")
def duration_minutes(spark: SparkSession, d: str) -> DataFrame:
    """FN1: minute boundaries crossed per staged trip."""
    stg = TripPlan(spark, d).stg_trips
    return stg.select("trip_id", "pickup_datetime", "dropoff_datetime",
                      minute_diff("pickup_datetime", "dropoff_datetime").alias("trip_duration_minutes"))


@register("mode_per_group")
def mode_per_group(spark: SparkSession, d: str) -> DataFrame:
    """AG6: busiest pickup hour per pickup location."""
    return models.mode_per_group(TripPlan(spark, d).trip_metrics, ["pickup_location_id"],
                                 "pickup_hour", "peak_pickup_hour")


# ------------------------------------------------------------- incremental
def _orders_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit(ORDERS_SPLIT[0]).cast("timestamp_ntz"))
    batch = (orders.filter(F.col("o_orderdate") >= F.lit(ORDERS_SPLIT[1]).cast("timestamp_ntz"))
             .withColumn("o_orderstatus", F.lit("F")))
    return target, batch


@register("upsert_by_key")
def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    """UP1: delete+insert of a batch of orders that overlaps the target."""
    target, batch = _orders_split(spark, d)
    return merge_by_key(target, batch, "o_orderkey")


@register("incremental_filter")
def incremental_filter(spark: SparkSession, d: str) -> DataFrame:
    """UP2: incoming orders strictly later than the target's newest order."""
    target, _ = _orders_split(spark, d)
    return incremental_rows(table(spark, d, "orders"), target, "o_orderdate")


# ------------------------------------------------------------------- checks
@register("run_checks")
def run_checks(spark: SparkSession, d: str) -> DataFrame:
    """DT1–DT7, DT9: the fact table's tests (row-level ones in one pass)."""
    return ck.run_checks(TripPlan(spark, d).fct_trips, ck.fact_checks(), "fct_trips")


@register("unique_check")
def unique_check(spark: SparkSession, d: str) -> DataFrame:
    """DT2 on order keys and line-item order keys."""
    return (ck.unique_check(table(spark, d, "orders"), "o_orderkey", "orders")
            .unionByName(ck.unique_check(table(spark, d, "lineitem"), "l_orderkey", "lineitem", "warn")))


@register("accepted_values_check")
def accepted_values_check(spark: SparkSession, d: str) -> DataFrame:
    """DT3 on event types and order status."""
    return (ck.run_row_checks(table(spark, d, "events"),
                              [ck.accepted_values("event_type", ["click", "view", "purchase", "signup"], "warn")],
                              "events")
            .unionByName(ck.run_row_checks(table(spark, d, "orders"),
                                           [ck.accepted_values("o_orderstatus", ["O", "F", "P"])], "orders")))


@register("accepted_range_check")
def accepted_range_check(spark: SparkSession, d: str) -> DataFrame:
    """DT5 with inclusive and exclusive bounds."""
    return (ck.run_row_checks(table(spark, d, "events"), [ck.accepted_range("value", 0, 400, severity="warn")],
                              "events")
            .unionByName(ck.run_row_checks(table(spark, d, "lineitem"), [
                ck.accepted_range("l_discount", 0, 0.1),
                ck.accepted_range("l_quantity", 0, 50, inclusive=False, severity="warn")], "lineitem")))


@register("relationship_check")
def relationship_check(spark: SparkSession, d: str) -> DataFrame:
    """DT4/JN3: child keys without a parent row."""
    p = TripPlan(spark, d)
    parts = [
        ck.relationships_check(table(spark, d, "orders"), "o_custkey", table(spark, d, "customer"),
                               "c_custkey", "orders"),
        ck.relationships_check(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part"),
                               "p_partkey", "lineitem"),
        ck.relationships_check(p.trip_metrics, "pickup_location_id", p.dim_locations, "location_id",
                               "trip_metrics", "warn"),
        ck.relationships_check(p.trip_metrics, "dropoff_location_id", p.dim_locations, "location_id",
                               "trip_metrics", "warn"),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@register("freshness")
def freshness(spark: SparkSession, d: str) -> DataFrame:
    """DT10: age of the newest event against a fixed 'now'."""
    import datetime as _dt

    now = _dt.datetime.fromisoformat(FRESHNESS_NOW)
    return ck.freshness(table(spark, d, "events"), "ts", now=now, source="events")


# ------------------------------------------------------------ reconciliation
def _layers(p: TripPlan) -> DataFrame:
    """RC1 of one run, from one read of the events: every message is parsed once, and its Bronze row is
    grouped by the de-dup key. A group counts its Bronze rows, and one Silver row if any
    of them passes the filters; the dead letters are groups of their own."""
    routed = parsing.parse_routed(p.topic, p.manifest, ingestion_ts=p.run_ts)
    rows = routed.select("rejected", "row.*")
    good = silver.filter_condition(p.manifest.quality_filters)
    groups = rows.groupBy("rejected", *p.manifest.dedup_key).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or(good), F.lit(False)).alias("passes"))
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.coalesce(F.sum(F.when(~F.col("rejected"), F.col("n"))), F.lit(0)).alias("bronze"),
        F.count_if(~F.col("rejected") & F.col("passes")).alias("silver"),
        F.coalesce(F.sum(F.when(F.col("rejected"), F.col("n"))), F.lit(0)).alias("dlq"))
    layers = [F.struct(F.lit(n).alias("layer"), F.col(n).cast("bigint").alias("rows"), F.lit(True).alias("ok"),
                       F.lit(None).cast("string").alias("message")) for n in ("events", "bronze", "silver", "dlq")]
    return totals.select(F.inline(F.array(*layers)))


@register("layer_counts")
def layer_counts(spark: SparkSession, d: str) -> DataFrame:
    """RC1: rows per layer of one pipeline run."""
    return _layers(TripPlan(spark, d))


@register("row_accounting")
def row_accounting(spark: SparkSession, d: str) -> DataFrame:
    """RC7: filtered and de-duplicated line items."""
    return reconcile.row_accounting(table(spark, d, "lineitem"), LINEITEM_FILTERS, LINEITEM_KEY)


@register("validation_report")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    """RC2–RC5, RC10: layer decisions and fact tests, in stage order."""
    p = TripPlan(spark, d)
    decisions = reconcile.layer_decisions(_layers(p), min_silver_rows=1, dlq_max=0)
    tests = reconcile.checks_as_report(ck.run_checks(p.fct_trips, ck.fact_checks(), "fct_trips"))
    return reconcile.validation_report([decisions, tests])


@register("bronze_rejects")
def bronze_rejects(spark: SparkSession, d: str) -> DataFrame:
    """PRJ1: messages that are no JSON document."""
    return TripPlan(spark, d).parsed.rejects.select("error", "payload")


@register("dlq_envelope")
def dlq_envelope(spark: SparkSession, d: str) -> DataFrame:
    """QG2: envelopes of the messages that fail the payload schema, opened again."""
    p = TripPlan(spark, d)
    _, rejected = parsing.split_by_schema(p.topic, trip_json_schema())
    sent = parsing.dlq_envelope(rejected, at=p.run_ts)
    value = F.col("value")
    return sent.select("error", F.get_json_object(value, "$.error").alias("error_sent"),
                       F.get_json_object(value, "$.timestamp").alias("rejected_at"),
                       F.get_json_object(value, "$.row.PULocationID").cast("bigint").alias("location"),
                       F.get_json_object(value, "$.row.tpep_dropoff_datetime").alias("dropoff"))


@register("readiness")
def readiness(spark: SparkSession, d: str) -> DataFrame:
    """RC6 over polls of event counts: a poll per event type and day, some of them failed."""
    polls = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("h")).agg(
        F.count_if(F.col("value") > 250).alias("rows"), (F.max("event_id") % 7 != 0).alias("ok"))
    polls = polls.select(F.col("event_type").alias("table"), "rows", "ok")
    return reconcile.readiness(polls, READY_ROWS, allow_empty=True)


@register("metrics_trust")
def metrics_trust(spark: SparkSession, d: str) -> DataFrame:
    """RC9 over run metrics made of the events: a run per user, some with a time that cannot be read."""
    import datetime as _dt

    runs = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("at"))
    metrics = runs.select(
        "events", F.lit("taxi").alias("dataset"), F.lit("taxi.trips").alias("topic"), F.lit("/data").alias("data_path"),
        F.lpad(F.col("user_id").cast("string"), 12, "0").alias("run_id"),
        F.when(F.col("user_id") % 3 == 0, F.lit("yesterday")).otherwise(
            F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("produced_at"))
    now = _dt.datetime.fromisoformat(FRESHNESS_NOW)
    cases = {"same": (metrics, "taxi"), "other dataset": (metrics, "orders"), "no metrics": (metrics.filter(F.col("events") < 0), "taxi")}
    out = None
    for case, (frame, dataset) in cases.items():
        part = reconcile.metrics_trust(frame, dataset, "taxi.trips", "/data", now=now, max_age_minutes=24 * 60).withColumn("case", F.lit(case))
        out = part if out is None else out.unionByName(part)
    return out


@register("contract_check")
def contract_check(spark: SparkSession, d: str) -> DataFrame:
    """DT8: the declared contracts of all marts, with the marts' row counts."""
    p = TripPlan(spark, d)
    out = None
    for name, ddl in models.CONTRACTS.items():
        frame = getattr(p, name)
        result = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in
                  zip(ck.RESULT_SCHEMA.fields, ck.contract_result(frame, ddl, name), strict=True)]
        part = frame.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(*result, "rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("mart_stub")
def mart_stub(spark: SparkSession, d: str) -> DataFrame:
    """PRJ11: the stub mart of a dataset, a view over its generic staging model."""
    p = TripPlan(spark, d)
    return models.mart_stub(models.stg_generic(p.silver, p.manifest), p.manifest)


@register("mart_location_ranked")
def mart_location_ranked(spark: SparkSession, d: str) -> DataFrame:
    """SO1: the location mart as it is presented, by revenue."""
    return models.presented("mart_location_performance", TripPlan(spark, d).mart_location_performance)


# ------------------------------------------------------ through the sinks
# These write below the shared folder first, and return what a reader finds there: each in a folder
# of its own (``queries/<name>``), which stays for the reader and is emptied when the query runs again.
def query_folder(spark: SparkSession, name: str) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/queries/{name}"
    remove(spark, path)
    return path


@register("topic_read")
def topic_read(spark: SparkSession, d: str) -> DataFrame:
    """SRC3, SNK2, SNK3: the messages of a file topic, with their keys."""
    path = query_folder(spark, "topic_read")
    write_file_topic(TripPlan(spark, d).topic, path)
    return read_file_topic(spark, path)


@register("published")
def published(spark: SparkSession, d: str) -> DataFrame:
    """SNK3, QG2: messages per key on the topic and per error on the dead-letter topic, after publishing with the schema gate."""
    p, path = TripPlan(spark, d), query_folder(spark, "published")
    publish(p.source, p.manifest, path, json_schema=trip_json_schema(), at=p.run_ts)
    sent = read_file_topic(spark, path).select(F.lit("topic").alias("topic"), "key")
    dead = read_file_topic(spark, dlq_path_of(path)).select(F.lit("dlq").alias("topic"), F.get_json_object("value", "$.error").alias("key"))
    return sent.unionByName(dead).groupBy("topic", "key").agg(F.count(F.lit(1)).alias("messages"))


@register("silver_table")
def silver_table(spark: SparkSession, d: str) -> DataFrame:
    """SNK4, SNK5, SRC7: Bronze appended, Silver computed from it and written by date, and read again."""
    from stratum.plans import pipeline

    p, warehouse = TripPlan(spark, d), query_folder(spark, "silver_table")
    run_ts = pipeline.run_bronze(spark, p.manifest, p.topic, warehouse, ingestion_ts=p.run_ts)
    pipeline.run_silver(spark, p.manifest, warehouse, run_ts)
    return spark.read.parquet(layer_path(warehouse, p.manifest.silver_table))


@register("upsert_table")
def upsert_table(spark: SparkSession, d: str) -> DataFrame:
    """UP1: the same upsert of orders on a table partitioned by year."""
    path = query_folder(spark, "upsert_table")
    target, batch = (df.withColumn("o_year", F.year("o_orderdate")) for df in _orders_split(spark, d))
    upsert_by_key_sink(spark, path, target, "o_orderkey", "o_year")
    upsert_by_key_sink(spark, path, batch, "o_orderkey", "o_year")
    return spark.read.parquet(path)


@register("bronze_stream")
def bronze_stream(spark: SparkSession, d: str) -> DataFrame:
    """ST1, SRC4: a topic drained by the streaming Bronze job, without its ingestion times."""
    from stratum.streaming.bronze import start_bronze_stream

    p, path = TripPlan(spark, d), query_folder(spark, "bronze_stream")
    write_file_topic(p.topic, f"{path}/topic")
    for q in start_bronze_stream(spark, p.manifest, f"{path}/topic", f"{path}/bronze", f"{path}/checkpoint", available_now=True):
        q.awaitTermination()
    return spark.read.parquet(f"{path}/bronze").drop("ingestion_ts")
