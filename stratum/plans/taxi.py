"""The trip pipeline over the driver tables, as named lazy DataFrames.

``TripPlan(spark, sf_dir)`` wires bindings → topic → Bronze → Silver →
staging → enrichment → fact → marts. Nothing runs until a DataFrame is acted
on; each registered query picks the node it needs, and Catalyst prunes the
rest (columns not used downstream are never read from Parquet).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stratum import manifest as mf
from stratum.operators import models, parsing, silver
from stratum.plans import bindings as b


class TripPlan:
    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: str | None = b.RUN_TS,
                 manifest: mf.Manifest | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run_ts = run_ts
        self.manifest = manifest or mf.builtin("taxi")

    def table(self, name: str) -> DataFrame:
        return b.table(self.spark, self.sf_dir, name)

    # ---- inputs --------------------------------------------------------
    @cached_property
    def source(self) -> DataFrame:
        return b.trip_source(self.table("events"))

    @cached_property
    def topic(self) -> DataFrame:
        return b.trip_topic(self.table("events"), self.manifest)

    @cached_property
    def parsed(self) -> parsing.Parsed:
        return parsing.parse_events(self.topic, self.manifest, ingestion_ts=self.run_ts)

    @property
    def bronze(self) -> DataFrame:
        return self.parsed.rows

    @cached_property
    def silver(self) -> DataFrame:
        return silver.silver(self.bronze, self.manifest)

    # ---- lookups -------------------------------------------------------
    @cached_property
    def zones_csv(self) -> DataFrame:
        return b.zones_lookup(self.table("customer"), self.table("nation"), self.table("region"))

    @cached_property
    def dim_locations(self) -> DataFrame:
        return models.dim_locations(self.zones_csv)

    @cached_property
    def dim_payment_types(self) -> DataFrame:
        return models.dim_payment_types(b.payment_lookup(self.table("events")))

    @cached_property
    def dim_rate_codes(self) -> DataFrame:
        return models.stg_rate_codes(b.rate_code_lookup(self.table("region")))

    @cached_property
    def dim_vendors(self) -> DataFrame:
        return models.dim_vendors(b.vendor_lookup(self.table("supplier")))

    # ---- marts ---------------------------------------------------------
    @cached_property
    def stg_trips(self) -> DataFrame:
        return models.stg_trips(self.silver)

    @cached_property
    def trip_metrics(self) -> DataFrame:
        return models.trip_metrics(self.stg_trips)

    @cached_property
    def fct_trips(self) -> DataFrame:
        return models.fct_trips(self.trip_metrics, self.dim_locations)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return models.daily_summary(self.trip_metrics)

    @cached_property
    def hourly_patterns(self) -> DataFrame:
        return models.hourly_patterns(self.trip_metrics)

    @cached_property
    def dim_dates(self) -> DataFrame:
        """The calendar of the events' days, of which the last ones are not closed yet (see ``bindings``)."""
        return models.dim_dates_until(b.event_days(self.table("events")), "day", b.OPEN_DAYS)

    @cached_property
    def calendar(self) -> DataFrame:
        """The calendar of the whole months of the events, so that no day of the fact is without a row."""
        return models.dim_dates_covering(b.event_days(self.table("events")), "day")

    @cached_property
    def mart_daily_revenue(self) -> DataFrame:
        return models.mart_daily_revenue(self.daily_summary, self.calendar)

    @cached_property
    def mart_hourly_demand(self) -> DataFrame:
        return models.mart_hourly_demand(self.hourly_patterns)

    @cached_property
    def mart_location_performance(self) -> DataFrame:
        return models.mart_location_performance(self.fct_trips)
