"""Running the layers as jobs (PL1, PL2).

``run_bronze``, ``run_silver``, ``run_trip_marts`` and ``validate`` are the steps;
``run_dataset`` is the generic path for any manifest: topic → Bronze append
→ Silver rebuild of the dates the batch touched (dynamic partition
overwrite, so re-running is idempotent) → checks and reconciliation.
``run_pipeline`` runs any of the steps in the fixed order
produce → bronze → silver → marts → validate.

Intermediate results that feed several models are written as tables (not
cached), so a lost executor costs a re-read, not a recomputation of the
whole lineage.
"""

from __future__ import annotations

import datetime as _dt
import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.manifest import Manifest
from stratum.operators import checks as ck
from stratum.operators import models, reconcile
from stratum.operators.parsing import parse_routed
from stratum.operators.silver import silver
from stratum.session import configure
from stratum.sinks.ledger import files_of_batch_dates, partition_date, update_ledger
from stratum.sinks.publish import publish
from stratum.sinks.tables import (
    _exists,
    append_bronze,
    full_refresh,
    in_partitions,
    incremental_rows,
    layer_path,
    remove,
    staging_path,
    upsert_by_key,
    write_silver,
)
from stratum.sources.events import read_file_topic

STEPS = ("produce", "bronze", "silver", "marts", "validate")


@dataclass
class RunResult:
    counts: DataFrame | None = None
    checks: DataFrame | None = None
    report: DataFrame | None = None
    tables: dict[str, str] = field(default_factory=dict)


def date_follows_key(manifest: Manifest, key: Sequence[str] | None = None) -> bool:
    """True when the partition date is computed only from columns of the key (the de-dup key
    by default), so all rows of one key land in one date partition."""
    used = {c for c in manifest.column_names
            if re.search(rf"(?<![A-Za-z0-9_]){re.escape(c)}(?![A-Za-z0-9_])", manifest.partition_date_expr)}
    return bool(used) and used <= set(manifest.dedup_key if key is None else key)


def silver_input(spark: SparkSession, manifest: Manifest, bronze_path: str, run_ts=None) -> DataFrame:
    """The Bronze rows Silver must be recomputed from: after a batch stamped ``run_ts``, when keys never
    cross dates, only the dates that batch touched, rows without a date among them (everything else in
    Silver is unchanged), read from the files that the ledger names; otherwise all of Bronze."""
    if run_ts is None or not date_follows_key(manifest):
        return spark.read.parquet(bronze_path)
    dates, files = files_of_batch_dates(spark, manifest, bronze_path, run_ts)
    if not files:
        return spark.read.parquet(bronze_path).limit(0)
    return spark.read.parquet(*files).filter(in_partitions(partition_date(manifest), dates))


def paths_of(manifest: Manifest, warehouse: str) -> dict[str, str]:
    return {"bronze": layer_path(warehouse, manifest.bronze_table), "silver": layer_path(warehouse, manifest.silver_table),
            "dlq": layer_path(warehouse, f"dlq.{manifest.name}"), "metrics": layer_path(warehouse, f"metrics.{manifest.name}")}


# ------------------------------------------------------------------- steps
def run_bronze(spark: SparkSession, manifest: Manifest, topic: DataFrame, warehouse: str, ingestion_ts=None,
               data_path: str = "") -> object:
    """Append a topic to Bronze and its rejects to the dead letters, in one parse, and add the run's
    metrics (RC8). Returns the run time that stamps the batch."""
    paths = paths_of(manifest, warehouse)
    # One run time for the whole batch, fixed on the driver, so this run's rows can be found again.
    run_ts = ingestion_ts or _dt.datetime.now(_dt.UTC).replace(tzinfo=None, microsecond=0)
    observation, began = Observation(f"bronze_{uuid.uuid4().hex[:8]}"), time.perf_counter()
    routed = parse_routed(topic, manifest, ingestion_ts=run_ts, observation=observation)
    stage = staging_path(spark, "bronze")
    routed.write.partitionBy("rejected").parquet(stage)
    staged = spark.read.schema(routed.schema).parquet(stage)
    append_bronze(staged.filter(~F.col("rejected")).select("row.*"), paths["bronze"])
    append_bronze(staged.filter(F.col("rejected")).select("error", "payload", "rejected_at"), paths["dlq"])
    update_ledger(spark, manifest, paths["bronze"])
    remove(spark, stage)
    metrics = reconcile.run_metrics(spark, observation.get, time.perf_counter() - began, mode="batch", dataset=manifest.name,
                                    topic=manifest.topic, data_path=data_path, run_id=uuid.uuid4().hex)
    append_bronze(metrics.coalesce(1), paths["metrics"])
    return run_ts


def run_silver(spark: SparkSession, manifest: Manifest, warehouse: str, run_ts=None) -> str:
    """Silver from Bronze, which stays as it is: the dates of the batch stamped ``run_ts``, or all."""
    rows = silver_input(spark, manifest, paths_of(manifest, warehouse)["bronze"], run_ts)
    full = run_ts is None or not date_follows_key(manifest)
    return write_silver(silver(rows, manifest), manifest, warehouse, full=full)


def validate(spark: SparkSession, manifest: Manifest, warehouse: str, events: int | None = None, min_silver_rows: int = 1,
             allow_empty: bool = False, dlq_max: int = 0, marts: dict[str, str] | None = None,
             now: _dt.datetime | None = None, data_path: str = "", check_metrics: bool = True) -> RunResult:
    """The staged report over the tables as they are: layer decisions, metrics trust, staging checks,
    and contracts and tests of the marts. Without ``events`` the source size is what the run metrics
    say was read; with neither, completeness fails. If an empty run is allowed and Silver is empty, the
    stages after it are not run."""
    paths = paths_of(manifest, warehouse)
    counts = reconcile.layer_counts(spark, {k: paths[k] for k in ("bronze", "silver", "dlq")})
    materialised = spark.createDataFrame(counts.collect(), reconcile.COUNT_SCHEMA)  # three rows, counted once
    metrics = spark.read.parquet(paths["metrics"]) if _exists(spark, paths["metrics"]) else \
        spark.createDataFrame([], reconcile.METRICS_SCHEMA)
    if events is None:
        events = metrics.agg(F.sum("events")).first()[0]
    parts = [reconcile.layer_decisions(materialised, events=events, min_silver_rows=min_silver_rows,
                                       allow_empty=allow_empty, dlq_max=dlq_max)]
    if check_metrics:
        parts.append(reconcile.metrics_trust(metrics, manifest.name, manifest.topic, data_path, now=now))
    silver_rows = {r.layer: r.rows for r in materialised.collect()}["silver"]
    checks = None
    if silver_rows > 0:
        stg = models.stg_generic(spark.read.parquet(paths["silver"]), manifest)
        checks = ck.run_checks(stg, ck.staging_checks(manifest), f"stg_{manifest.name}")
        parts.append(reconcile.checks_as_report(checks))
        for name, path in (marts or {}).items():
            if name in models.CONTRACTS:
                frame = spark.read.parquet(path)
                parts.append(reconcile.checks_as_report(ck.contract_check(frame, models.CONTRACTS[name], name), "marts"))
                if name == "fct_trips":
                    parts.append(reconcile.checks_as_report(ck.run_checks(frame, ck.fact_checks(), name), "marts"))
    return RunResult(materialised, checks, reconcile.validation_report(parts), paths)


def run_dataset(spark: SparkSession, manifest: Manifest, topic: DataFrame, warehouse: str,
                ingestion_ts=None, min_silver_rows: int = 1, allow_empty: bool = False,
                dlq_max: int = 0, events: int | None = None) -> RunResult:
    """PL1: Bronze append, Silver rebuild of the touched dates, staging
    checks and counts. Re-running a batch is idempotent."""
    configure(spark)
    run_ts = run_bronze(spark, manifest, topic, warehouse, ingestion_ts)
    run_silver(spark, manifest, warehouse, run_ts)
    return validate(spark, manifest, warehouse, events=events, min_silver_rows=min_silver_rows, allow_empty=allow_empty, dlq_max=dlq_max)


def run_trip_marts(spark: SparkSession, silver_df: DataFrame, zones_csv: DataFrame, warehouse: str,
                   incremental: bool = False, calendar: tuple[str, str] | None = None,
                   lookback: str | None = None, lookups: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """The trip marts as tables under ``<warehouse>/marts``, with the staging models as views.

    ``trip_metrics`` feeds three models, so it is written once and re-read.
    ``fct_trips`` is rebuilt, or upserted by ``trip_id`` when ``incremental``: only Silver rows later than
    the fact's newest pickup (minus ``lookback``) are read, enriched and merged, and the
    enriched table takes the same rows. ``lookups`` may hold ``payment_types``,
    ``rate_codes`` and ``vendors``, which become dimension tables too.
    """
    out: dict[str, str] = {}

    def path_of(name: str) -> str:
        out[name] = f"{warehouse.rstrip('/')}/marts/{name}"
        return out[name]

    def save(name: str, df: DataFrame, partition_col: str | None = None) -> DataFrame:
        full_refresh(df, path_of(name), partition_col)
        return spark.read.parquet(out[name])

    dims = save("dim_locations", models.dim_locations(zones_csv))
    for name, model in (("payment_types", models.dim_payment_types), ("rate_codes", models.stg_rate_codes), ("vendors", models.dim_vendors)):
        if lookups and name in lookups:
            save(f"dim_{name}", model(lookups[name]))
    fct_path, metrics_path = path_of("fct_trips"), path_of("int_trip_metrics")
    if incremental and _exists(spark, fct_path):
        new = incremental_rows(silver_df, spark.read.parquet(fct_path), "pickup_datetime", lookback, "pickup_date")
        fresh = models.trip_metrics(models.stg_trips(new))
        upsert_by_key(spark, metrics_path, fresh, "trip_id", "pickup_date")
        metrics = spark.read.parquet(metrics_path)
        later = incremental_rows(metrics, spark.read.parquet(fct_path), "pickup_datetime", lookback, "pickup_date")
        upsert_by_key(spark, fct_path, models.fct_trips(later, dims), "trip_id", "pickup_date")
        fct = spark.read.parquet(fct_path)
    else:
        metrics = save("int_trip_metrics", models.trip_metrics(models.stg_trips(silver_df)), "pickup_date")
        fct = save("fct_trips", models.fct_trips(metrics, dims), "pickup_date")
    models.stg_trips(silver_df).createOrReplaceTempView("stg_trips")
    dates = save("dim_dates", models.dim_dates(spark, *calendar) if calendar else models.dim_dates(spark))
    daily = save("int_daily_summary", models.daily_summary(metrics))
    save("mart_daily_revenue", models.mart_daily_revenue(daily, dates))
    save("mart_hourly_demand", models.mart_hourly_demand(models.hourly_patterns(metrics)))
    save("mart_location_performance", models.mart_location_performance(fct))
    return out


def run_pipeline(spark: SparkSession, manifest: Manifest, warehouse: str, source: DataFrame | None = None,
                 topic_path: str | None = None, zones_csv: DataFrame | None = None,
                 steps: Sequence[str] = STEPS, json_schema: dict | None = None, **validation) -> RunResult:
    """PL2: the steps in order; any subset may be given (order is fixed) and each does only its own
    work. ``marts`` needs the zone lookup. ``validation`` goes to ``validate``."""
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    configure(spark)
    topic_path = topic_path or f"{warehouse.rstrip('/')}/topics/{manifest.topic}"
    result = RunResult(tables=paths_of(manifest, warehouse))
    run_ts = None
    if "produce" in steps:
        if source is None:
            raise ValueError("produce needs a source DataFrame")
        publish(source, manifest, topic_path, json_schema=json_schema)
    if "bronze" in steps:
        run_ts = run_bronze(spark, manifest, read_file_topic(spark, topic_path), warehouse, data_path=topic_path)
    if "silver" in steps:
        run_silver(spark, manifest, warehouse, run_ts)
    marts: dict[str, str] = {}
    if "marts" in steps:
        if zones_csv is None:
            raise ValueError("marts needs the zone lookup")
        marts = run_trip_marts(spark, spark.read.parquet(result.tables["silver"]), zones_csv, warehouse)
    if "validate" in steps:
        result = validate(spark, manifest, warehouse, marts=marts, data_path=topic_path, **validation)
    result.tables.update(marts)
    return result
