"""Staging, enrichment, dimensions, fact and marts (PRJ8–PRJ11, ENR1, FN*,
GN1–GN2, DM1, JN1–JN2, AG1–AG6, WN2–WN4).

Every model is ``DataFrame -> DataFrame``. Aggregates are hash aggregates with
a partial (map-side) step, so a hot group never ships more than one partial
row per map task. The only unpartitioned window (running totals in
``mart_daily_revenue``) runs on one row per calendar day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import (
    avg_double,
    avg_stable,
    calendar_parts,
    hour_of_day,
    in_dates,
    is_weekend,
    minute_diff,
    month_name,
    round_half_away,
    safe_ratio,
    sum_decimal,
    weekday_name,
)
from stratum.manifest import Manifest

MONEY = T.DecimalType(10, 2)
EXACT = T.DecimalType(38, 15)  # sums of doubles that do not depend on their order
MONEY_COLS = ("fare_amount", "extra_amount", "mta_tax", "tip_amount", "tolls_amount",
              "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee")

# The holiday calendar of the date dimension.
HOLIDAYS = ("2024-01-01", "2024-01-15")
CALENDAR_START, CALENDAR_END = "2024-01-01", "2024-02-01"


# ------------------------------------------------------------------ staging
def stg_trips(silver: DataFrame) -> DataFrame:
    """Fact staging (PRJ8): column order for the marts, timestamps as
    timestamps, money re-typed DECIMAL(10,2), rows without pickup or dropoff
    time dropped."""
    money = [F.round(F.col(c).cast(MONEY), 2).cast(MONEY).alias(c) for c in MONEY_COLS]
    return (silver
            .filter(F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull())
            .select("trip_id", "vendor_id", "rate_code_id", "pickup_location_id",
                    "dropoff_location_id", "payment_type_id",
                    F.col("pickup_datetime").cast(T.TimestampNTZType()).alias("pickup_datetime"),
                    F.col("dropoff_datetime").cast(T.TimestampNTZType()).alias("dropoff_datetime"),
                    "passenger_count", "trip_distance_miles", "store_and_fwd_flag", *money))


def stg_generic(silver: DataFrame, manifest: Manifest) -> DataFrame:
    """Generic staging (PRJ9): key, timestamps, partition date, the other
    columns, ``ingestion_ts``; rows without event time dropped."""
    key = manifest.resolved_surrogate_key_name
    ts_cols = [c.silver_output_name for c in manifest.columns
               if c.parse_timestamp or c.silver_type.upper().startswith("TIMESTAMP")]
    ts_cols.sort(key=lambda n: n != manifest.event_ts_silver_col)
    rest = [c.silver_output_name for c in manifest.columns if c.silver_output_name not in ts_cols]
    return (silver.filter(F.col(manifest.event_ts_silver_col).isNotNull())
            .select(key, *ts_cols, manifest.partition_date_col, *rest, "ingestion_ts"))


def stg_zones(zones_csv: DataFrame) -> DataFrame:
    """Zone lookup staging (PRJ10). Location ids are kept BIGINT so keys
    beyond 2^31 survive."""
    return zones_csv.select(F.col("LocationID").cast("bigint").alias("location_id"),
                            F.col("Borough").alias("borough"), F.col("Zone").alias("zone_name"),
                            F.col("service_zone"))


def stg_payment_types(df: DataFrame) -> DataFrame:
    return df.select(F.col("payment_type_id").cast("int"), "payment_type_name")


def stg_rate_codes(df: DataFrame) -> DataFrame:
    return df.select(F.col("rate_code_id").cast("int"), "rate_code_name")


def stg_vendors(df: DataFrame) -> DataFrame:
    return df.select("vendor_id", "vendor_name", "vendor_abbr")


dim_locations = stg_zones          # DM1: pass-through dimensions
dim_payment_types = stg_payment_types
dim_vendors = stg_vendors


# --------------------------------------------------------------- enrichment
def trip_metrics(stg: DataFrame) -> DataFrame:
    """ENR1: duration (minute boundaries), speed, cost per mile, tip share,
    calendar fields; keeps plausible trips (1–720 min, speed NULL or < 100)."""
    dur = minute_diff("pickup_datetime", "dropoff_datetime")
    enriched = stg.withColumn("trip_duration_minutes", dur)
    d = F.col("trip_duration_minutes")
    speed = F.when(d > 0, round_half_away(
        F.col("trip_distance_miles") / (d.cast("double") / F.lit(60.0)), 2))
    pu = F.col("pickup_datetime")
    out = enriched.select(
        "trip_id", "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
        "payment_type_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
        "trip_distance_miles", "store_and_fwd_flag", "trip_duration_minutes",
        speed.alias("avg_speed_mph"),
        safe_ratio("fare_amount", "trip_distance_miles").alias("cost_per_mile"),
        safe_ratio("tip_amount", "fare_amount", scale=100.0).alias("tip_percentage"),
        F.to_date(pu).alias("pickup_date"),
        hour_of_day(pu).alias("pickup_hour"),
        weekday_name(pu).alias("pickup_day_of_week"),
        is_weekend(pu).alias("is_weekend"),
        *MONEY_COLS)
    return out.filter(d.between(1, 720) & (F.col("avg_speed_mph").isNull()
                                          | (F.col("avg_speed_mph") < 100)))


# --------------------------------------------------------------- dimensions
def dim_dates_from(bounds: DataFrame) -> DataFrame:
    """GN2 over a one-row frame ``(start DATE, end DATE)``: one row per day in
    ``[start, end)`` with calendar fields, weekend and holiday flags.
    The spine is generated on the executors (GN1)."""
    spine = bounds.select(F.explode(F.sequence(
        F.col("start"), F.date_sub(F.col("end"), 1), F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    d = F.col("date_key")
    parts = calendar_parts(d)
    return spine.select(
        d.alias("date_key"), parts["year"].alias("year"), parts["month"].alias("month"),
        parts["day_of_month"].alias("day_of_month"), parts["day_of_week_num"].alias("day_of_week_num"),
        weekday_name(d).alias("day_of_week_name"), month_name(d).alias("month_name"),
        parts["week_of_year"].alias("week_of_year"), is_weekend(d).alias("is_weekend"),
        in_dates(d, HOLIDAYS).alias("is_holiday"))


def dim_dates(spark, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Calendar for ``[start, end)`` (January 2024 by default)."""
    bounds = spark.range(1).select(F.lit(_dt.date.fromisoformat(start)).alias("start"),
                                   F.lit(_dt.date.fromisoformat(end)).alias("end"))
    return dim_dates_from(bounds)


def dim_dates_covering(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar of whole months covering the dates in ``df[date_col]``; the
    bounds are a Spark aggregate, not a driver round trip."""
    bounds = df.agg(F.trunc(F.min(date_col), "MM").alias("start"),
                    F.add_months(F.trunc(F.max(date_col), "MM"), 1).alias("end"))
    return dim_dates_from(bounds)


def dim_dates_until(df: DataFrame, date_col: str, open_days: int) -> DataFrame:
    """Calendar from the first day of the first month in ``df[date_col]`` to the newest day there, without
    the newest ``open_days`` days."""
    bounds = df.agg(F.trunc(F.min(date_col), "MM").alias("start"), F.date_sub(F.max(date_col), open_days - 1).alias("end"))
    return dim_dates_from(bounds)


# --------------------------------------------------------------------- fact
def fct_trips(metrics: DataFrame, locations: DataFrame) -> DataFrame:
    """Trips with pickup and dropoff zone names (JN1): two LEFT joins to one
    dimension, broadcast by adaptive execution if its measured bytes allow."""
    dim = locations.select("location_id", "borough", "zone_name")
    pu = dim.select(F.col("location_id").alias("_pu_id"), F.col("borough").alias("pickup_borough"),
                    F.col("zone_name").alias("pickup_zone"))
    do = dim.select(F.col("location_id").alias("_do_id"), F.col("borough").alias("dropoff_borough"),
                    F.col("zone_name").alias("dropoff_zone"))
    joined = (metrics
              .join(pu, metrics["pickup_location_id"] == pu["_pu_id"], "left")
              .join(do, metrics["dropoff_location_id"] == do["_do_id"], "left"))
    return joined.select(
        "trip_id", "vendor_id", "rate_code_id", "payment_type_id", "pickup_location_id",
        "dropoff_location_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour",
        "pickup_day_of_week", "is_weekend", "passenger_count", "trip_distance_miles",
        "trip_duration_minutes", "avg_speed_mph", "cost_per_mile", "fare_amount", "extra_amount",
        "mta_tax", "tip_amount", "tip_percentage", "tolls_amount", "improvement_surcharge",
        "total_amount", "congestion_surcharge", "airport_fee", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone")


# --------------------------------------------------------------- aggregates
def _r2(c: Column) -> Column:
    return round_half_away(c, 2)


def daily_summary(metrics: DataFrame) -> DataFrame:
    """AG1/AG2: one row per day."""
    return metrics.groupBy("pickup_date", "pickup_day_of_week", "is_weekend").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("passenger_count").cast("bigint").alias("total_passengers"),
        _r2(avg_stable("trip_distance_miles")).alias("avg_trip_distance"),
        _r2(F.avg("trip_duration_minutes")).alias("avg_trip_duration_min"),
        _r2(avg_stable("avg_speed_mph")).alias("avg_speed_mph"),
        sum_decimal("fare_amount").alias("total_fare_revenue"),
        sum_decimal("tip_amount").alias("total_tip_revenue"),
        sum_decimal("total_amount").alias("total_revenue"),
        _r2(avg_double("total_amount")).alias("avg_trip_revenue"),
        _r2(avg_stable("tip_percentage")).alias("avg_tip_percentage"),
        F.count_if(F.col("payment_type_id") == 1).alias("credit_card_trips"),
        F.count_if(F.col("payment_type_id") == 2).alias("cash_trips"))


def hourly_patterns(metrics: DataFrame) -> DataFrame:
    """AG3: one row per (day, hour)."""
    return metrics.groupBy("pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _r2(avg_stable("trip_distance_miles")).alias("avg_distance"),
        _r2(F.avg("trip_duration_minutes")).alias("avg_duration_min"),
        sum_decimal("total_amount").alias("total_revenue"),
        _r2(avg_double("total_amount")).alias("avg_revenue"))


def mart_hourly_demand(hourly: DataFrame) -> DataFrame:
    """AG4: hourly profile across days (averages of daily-hour figures)."""
    return hourly.groupBy("pickup_hour", "is_weekend").agg(
        F.count(F.lit(1)).alias("days_observed"),
        round_half_away(F.avg("total_trips"), 0).alias("avg_trips_per_period"),
        _r2(avg_stable("avg_distance")).alias("avg_distance"),
        _r2(avg_stable("avg_duration_min")).alias("avg_duration_min"),
        _r2(avg_double("total_revenue")).alias("avg_revenue_per_period"),
        F.sum("total_trips").cast("bigint").alias("total_trips_all_days"))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """AG6: the most frequent non-NULL ``value`` per group; ties go to the
    smallest value. Groups with only NULLs get no row.

    Two hash aggregations instead of one map-valued buffer per group: the
    first counts (group, value) pairs with map-side combining, the second
    picks the winner among at most #distinct-values rows per group. Neither
    holds a whole group in memory, however hot the group is.
    """
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias(alias))


def mart_location_performance(fct: DataFrame) -> DataFrame:
    """AG5: per pickup zone, with the most common dropoff zone and hour.

    The fact is read once: every trip gives a plain row, which carries the measures,
    and a row for each of the two values whose mode is wanted. One aggregation by
    (zone, kind, value) has exact partial sums in its plain rows and counts in the
    others; a second one per zone adds up the former and picks the modes from
    the latter, ties to the smallest value.
    """
    keys = ["pickup_location_id", "pickup_borough", "pickup_zone"]
    measures = {"trip_distance_miles": EXACT, "trip_duration_minutes": T.LongType(), "total_amount": MONEY,
                "tip_percentage": EXACT, "passenger_count": T.LongType()}
    trips = fct.filter(F.col("pickup_zone").isNotNull())
    values = F.array(*[F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value")) for kind, value in (
        ("all", F.lit(None)), ("zone", F.col("dropoff_zone")), ("hour", F.lpad(F.col("pickup_hour").cast("string"), 2, "0")))])
    rows = trips.select(*keys, *measures, F.explode(values).alias("v")).select(*keys, *measures, "v.*")
    rows = rows.filter((F.col("kind") == "all") | F.col("value").isNotNull())
    plain = F.col("kind") == "all"
    counts = rows.groupBy(*keys, "kind", "value").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(plain, F.col(m).cast(t))).alias(f"{m}_s") for m, t in measures.items()],
        *[F.count(F.when(plain, F.col(m))).alias(f"{m}_n") for m in measures])

    def mean(m: str) -> Column:
        return F.try_divide(F.sum(f"{m}_s").cast("double"), F.sum(f"{m}_n").cast("double"))

    def mode(kind: str) -> Column:
        own = F.col("kind") == kind
        best = F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))
        return F.min(F.when(own, best)).getField("v")

    return counts.groupBy(*keys).agg(
        F.sum(F.when(plain, F.col("n"))).cast("bigint").alias("total_pickups"),
        _r2(mean("trip_distance_miles")).alias("avg_trip_distance"),
        _r2(mean("trip_duration_minutes")).alias("avg_trip_duration_min"),
        F.sum("total_amount_s").cast(T.DecimalType(38, 2)).alias("total_revenue"),
        _r2(mean("total_amount")).alias("avg_revenue_per_trip"),
        _r2(mean("tip_percentage")).alias("avg_tip_pct"),
        _r2(mean("passenger_count")).alias("avg_passengers"),
        mode("zone").alias("most_common_dropoff_zone"),
        mode("hour").cast("bigint").alias("peak_pickup_hour"))


def mart_daily_revenue(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """WN4: daily figures on the calendar (days outside it drop out) with a
    running revenue total (WN2) and the change against the previous row (WN3).

    The window has no partition key on purpose: it runs after the daily
    aggregation, on one row per calendar day.
    """
    joined = daily.join(dates.select("date_key", "day_of_week_name", "is_weekend", "is_holiday", "week_of_year"),
                        daily["pickup_date"] == F.col("date_key"), "inner")
    w = Window.orderBy("date_key")
    running = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        "date_key", "day_of_week_name", dates["is_weekend"].alias("is_weekend"), "is_holiday",
        "week_of_year", "total_trips", "total_passengers", "total_fare_revenue",
        "total_tip_revenue", "total_revenue", "avg_trip_revenue", "avg_tip_percentage",
        "credit_card_trips", "cash_trips", "avg_trip_distance", "avg_trip_duration_min",
        F.sum("total_revenue").over(running).cast(T.DecimalType(38, 2)).alias("cumulative_revenue"),
        (F.col("total_revenue") - F.lag("total_revenue").over(w)).cast(T.DecimalType(38, 2))
        .alias("revenue_change_vs_prior_day"))


# ------------------------------------------------------------- presentation
# Sort order in which a mart is shown (SO1); tables are not kept in it.
PRESENTED = {"mart_hourly_demand": ("is_weekend", "pickup_hour"), "mart_location_performance": ("-total_revenue", "pickup_location_id")}


def presented(name: str, mart: DataFrame) -> DataFrame:
    """SO1: a mart in its order of presentation."""
    return mart.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in PRESENTED[name]])


def mart_stub(stg: DataFrame, manifest: Manifest) -> DataFrame:
    """PRJ11: ``mart_<dataset>``, a view of all columns of the generic staging model."""
    name = f"mart_{manifest.name}"
    stg.createOrReplaceTempView(name)
    return stg.sparkSession.table(name)


# ---------------------------------------------------------------- contracts
# Declared columns and types of the marts (DT8; fixed values).
CONTRACTS: dict[str, str] = {
    "fct_trips": (
        "trip_id STRING, vendor_id INT, rate_code_id INT, payment_type_id INT, pickup_location_id INT, dropoff_location_id INT, "
        "pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ, pickup_date DATE, pickup_hour BIGINT, "
        "pickup_day_of_week STRING, is_weekend BOOLEAN, passenger_count INT, trip_distance_miles DOUBLE, "
        "trip_duration_minutes BIGINT, avg_speed_mph DOUBLE, cost_per_mile DOUBLE, fare_amount DECIMAL(10,2), "
        "extra_amount DECIMAL(10,2), mta_tax DECIMAL(10,2), tip_amount DECIMAL(10,2), tip_percentage DOUBLE, "
        "tolls_amount DECIMAL(10,2), improvement_surcharge DECIMAL(10,2), total_amount DECIMAL(10,2), "
        "congestion_surcharge DECIMAL(10,2), airport_fee DECIMAL(10,2), pickup_borough STRING, pickup_zone STRING, "
        "dropoff_borough STRING, dropoff_zone STRING"),
    "dim_dates": (
        "date_key DATE, year BIGINT, month BIGINT, day_of_month BIGINT, day_of_week_num BIGINT, day_of_week_name STRING, "
        "month_name STRING, week_of_year BIGINT, is_weekend BOOLEAN, is_holiday BOOLEAN"),
    "dim_locations": "location_id BIGINT, borough STRING, zone_name STRING, service_zone STRING",
    "mart_daily_revenue": (
        "date_key DATE, day_of_week_name STRING, is_weekend BOOLEAN, is_holiday BOOLEAN, week_of_year BIGINT, "
        "total_trips BIGINT, total_passengers BIGINT, total_fare_revenue DECIMAL(38,2), total_tip_revenue DECIMAL(38,2), "
        "total_revenue DECIMAL(38,2), avg_trip_revenue DOUBLE, avg_tip_percentage DOUBLE, credit_card_trips BIGINT, "
        "cash_trips BIGINT, avg_trip_distance DOUBLE, avg_trip_duration_min DOUBLE, cumulative_revenue DECIMAL(38,2), "
        "revenue_change_vs_prior_day DECIMAL(38,2)"),
    "mart_hourly_demand": (
        "pickup_hour BIGINT, is_weekend BOOLEAN, days_observed BIGINT, avg_trips_per_period DOUBLE, avg_distance DOUBLE, "
        "avg_duration_min DOUBLE, avg_revenue_per_period DOUBLE, total_trips_all_days BIGINT"),
    "mart_location_performance": (
        "pickup_location_id INT, pickup_borough STRING, pickup_zone STRING, total_pickups BIGINT, avg_trip_distance DOUBLE, "
        "avg_trip_duration_min DOUBLE, total_revenue DECIMAL(38,2), avg_revenue_per_trip DOUBLE, avg_tip_pct DOUBLE, "
        "avg_passengers DOUBLE, most_common_dropoff_zone STRING, peak_pickup_hour BIGINT"),
}
