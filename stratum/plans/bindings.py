"""Bindings of the driver tables to the pipeline's inputs.

The pipeline is written for flat trip events (see ``datasets/taxi.yml``) and
CSV lookups. The test tables are a generic event stream and a TPC-H-like star
schema, so these functions shape them into those inputs. Every binding is a
per-row projection or a join over the *whole* table; no rows are sampled.

* trips source  ← ``events``: one trip per event. ``props.k`` drives the trip
  length in minutes and a few categorical fields; events of type ``error``
  reach the topic without a pickup time (the producer could not stamp them),
  which exercises the schema gate and the quality filters.
  Every 40th event starts at a location that no customer has, so that joins
  and referential checks see rows without a parent.
* topic         ← the encoded trips; of every 50 messages one is cut off in the
  middle (no JSON document any more) and one lacks its dropoff time.
* zones lookup  ← ``customer ⋈ nation ⋈ region``: a location per customer;
  borough = region name, zone = nation name, service zone = market segment.
* payment types ← distinct event types of ``events``.
* calendar      ← the whole months of the days of ``events``; ``dim_dates`` shows it from the first of their first
  month, without the newest OPEN_DAYS days.
* rate codes    ← ``region``.
* vendors       ← ``supplier``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.manifest import Manifest
from stratum.operators.parsing import encode_events
from stratum.sources.tables import deal_single_split, scan

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed values of the bindings.
# event type -> payment type id (5 = unknown)
PAYMENT_CODES = {"purchase": 1, "click": 2, "view": 3, "signup": 4, "error": 5}
# Newest days that the query dim_dates does not show yet.
OPEN_DAYS = 2
# The run time stamped on Bronze rows by the registered queries, so results
# are reproducible; a real run uses current_timestamp().
RUN_TS = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; ``events``, whose rows are encoded and parsed as JSON, never by a few tasks only."""
    df = scan(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return deal_single_split(df) if name == "events" else df


def event_days(events: DataFrame) -> DataFrame:
    return events.select(F.to_date("ts").alias("day"))


def _payment_code(event_type):
    expr = None
    for name, code in PAYMENT_CODES.items():
        cond = event_type == F.lit(name)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.cast("bigint")


def trip_source(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` → rows with the raw trip columns of the taxi manifest, and the columns in ``keep``."""
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    pickup = F.col("ts").cast("timestamp_ntz")
    dropoff = F.timestamp_add("SECOND", k * 60 + F.col("event_id") % 60, pickup)
    value = F.col("value")
    return events.select(
        (F.lit(1) + F.col("user_id") % 2).cast("bigint").alias("VendorID"),
        F.when(F.col("event_type") != F.lit("error"), pickup).alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        (k % 5).alias("passenger_count"),
        (value / 10).alias("trip_distance"),
        (F.lit(1) + k % 6).alias("RatecodeID"),
        F.when(k % 2 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("store_and_fwd_flag"),
        F.when(F.col("event_id") % 40 == 3, -F.col("user_id")).otherwise(F.col("user_id")).cast("bigint").alias("PULocationID"),
        (F.col("user_id") + k).cast("bigint").alias("DOLocationID"),
        _payment_code(F.col("event_type")).alias("payment_type"),
        (value * 0.8).alias("fare_amount"),
        ((k % 3) * 0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (value * 0.2).alias("tip_amount"),
        F.when(k % 10 == 0, F.lit(6.55)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        value.alias("total_amount"),
        F.when(k % 2 == 0, F.lit(2.5)).otherwise(F.lit(0.0)).alias("congestion_surcharge"),
        F.when(k % 4 == 0, F.lit(1.25)).otherwise(F.lit(0.0)).alias("Airport_fee"),
        *keep)


def zones_lookup(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Rows shaped like the zone CSV: ``LocationID, Borough, Zone, service_zone``.

    nation (25 rows) and region (5 rows) are fixed-size by construction of the
    schema, so they are broadcast; customer is the big side and is not.
    """
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                      .select("n_nationkey", "n_name", "r_name"))
    return (customer
            .join(geo, customer.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey").alias("LocationID"), F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone"), F.col("c_mktsegment").alias("service_zone")))


def trip_topic(events: DataFrame, manifest: Manifest) -> DataFrame:
    """The trips as messages, with the malformed and incomplete ones that a real topic has."""
    messages = encode_events(trip_source(events, ("event_id",)), manifest, keep=("event_id",))
    value = F.col("value")
    cut = F.substring(value, F.lit(1), (F.length(value) / 2).cast("int"))
    incomplete = F.regexp_replace(value, ',"tpep_dropoff_datetime":"[^"]*"', "")
    return messages.select("key", F.when(F.col("event_id") % 50 == 0, cut)
                           .when(F.col("event_id") % 50 == 1, incomplete).otherwise(value).alias("value"))


def payment_lookup(events: DataFrame) -> DataFrame:
    return (events.select(_payment_code(F.col("event_type")).cast("int").alias("payment_type_id"),
                          F.col("event_type").alias("payment_type_name"))
            .distinct())


def rate_code_lookup(region: DataFrame) -> DataFrame:
    return region.select((F.col("r_regionkey") + 1).cast("int").alias("rate_code_id"),
                         F.col("r_name").alias("rate_code_name"))


def vendor_lookup(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"),
                           F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("vendor_abbr"))
