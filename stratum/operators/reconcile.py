"""Row-count reconciliation between layers and the staged validation report
(RC1–RC10), computed as Spark jobs over the layer tables.

Counts are single-row global aggregates (one partial count per task, one
final row), unioned into one DataFrame so all layers are counted in one
job. The decision rules (completeness, bounds, allow-empty, DLQ threshold,
readiness, metrics trust) are column expressions over those counts.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.silver import filter_condition

COUNT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("message", T.StringType()),
])

CHECK_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("message", T.StringType()),
    T.StructField("detail", T.StringType()),
])

# Fixed values of the reconciliation rules.
BRONZE_COMPLETENESS = 0.95   # bronze >= int(events * 0.95)
PRODUCED_COMPLETENESS = 0.99  # produced >= 99 % of the source rows
METRICS_MAX_AGE_MIN = 120     # run metrics older than this are stale


# ------------------------------------------------------------------- counts
def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads Parquet through the connector that answers counts from
    file footers; the settings of ``spark`` itself stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def layer_counts(spark: SparkSession, layers: Mapping[str, DataFrame | str]) -> DataFrame:
    """RC1: ``(layer, rows, ok, message)`` per layer. A layer given as a path is counted from its
    files' footers, without a data page read; one that cannot be read reports ``rows = -1`` and
    the error text."""
    parts, footers = [], footer_session(spark)
    for name, src in layers.items():
        if isinstance(src, str):
            try:
                src = footers.read.parquet(src)
            except Exception as exc:  # noqa: BLE001 - reported as a row
                parts.append(spark.createDataFrame([(name, -1, False, str(exc))], COUNT_SCHEMA))
                continue
        parts.append(src.agg(F.count(F.lit(1)).alias("rows")).select(
            # files without a row group have no footer count to add up: then the sum is NULL
            F.lit(name).alias("layer"), F.greatest("rows", F.lit(0)).cast("bigint").alias("rows"), F.lit(True).alias("ok"),
            F.lit(None).cast("string").alias("message")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- decisions
def _check(stage: str, name: str, passed: Column, message: Column, detail: Column | None = None) -> Column:
    return F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("name"), passed.alias("passed"),
                    message.alias("message"),
                    (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def layer_decisions(counts: DataFrame, events: int | Column | None = None, min_silver_rows: int = 1,
                    allow_empty: bool = False, dlq_max: int = 0) -> DataFrame:
    """RC2–RC5 over RC1 counts (layers ``events``, ``bronze``, ``silver``, optional ``dlq``).

    * bronze completeness: bronze >= int(events × 0.95); an unknown source size fails;
    * silver bounds: silver >= min rows, silver <= max(bronze, 1);
    * DLQ: dead letters <= ``dlq_max``; a layer that is not listed has none;
    * a layer that could not be read fails its checks with its message;
    * allow-empty: an empty bronze passes only when allowed, and then the checks
      after it are skipped (passed, and named as skipped).
    """
    def of(layer: str, value: Column) -> Column:
        return F.max(F.when(F.col("layer") == layer, value))

    names = ("events", "bronze", "silver", "dlq")
    readable = F.coalesce(F.col("ok"), F.lit(False)) & (F.col("rows") >= 0)
    w = counts.groupBy().agg(
        *[of(n, F.when(readable, F.col("rows"))).alias(n) for n in names],
        *[of(n, F.when(~readable, F.coalesce("message", F.lit("no message")))).alias(f"{n}_error") for n in names])
    # Source size: given, or the ``events`` layer of the counts.
    ev = F.lit(events) if isinstance(events, int) else events if events is not None else F.col("events")
    w = w.withColumn("need", F.floor(ev.cast("double") * F.lit(BRONZE_COMPLETENESS)).cast("bigint"))
    bronze, silver, need = F.col("bronze"), F.col("silver"), F.col("need")
    empty = F.lit(allow_empty) & F.coalesce(bronze == 0, F.lit(False))

    def decide(stage: str, name: str, inputs: tuple[str, ...], passed: Column, message: Column, skip: bool = True) -> Column:
        """The check, failed if an input is missing or could not be read."""
        known, text = F.lit(True), message
        for n in reversed(inputs):
            known = known & F.col(n).isNotNull()
            text = F.when(F.col(f"{n}_error").isNotNull(), F.concat(F.lit(f"{n} unreadable: "), F.col(f"{n}_error"))).when(
                F.col(n).isNull(), F.lit(f"{n} unknown")).otherwise(text)
        ok = F.coalesce(known & passed, F.lit(False))
        if skip:
            ok, text = empty | ok, F.when(empty, F.lit("skipped: bronze is empty (allowed)")).otherwise(text)
        return _check(stage, name, ok, text)

    impossible = silver > F.greatest(bronze, F.lit(1))
    dead = F.coalesce("dlq", F.lit(0))
    checks = [
        decide("bronze", "bronze_completeness", ("bronze",),
               F.when(bronze == 0, F.lit(allow_empty)).otherwise(F.coalesce(bronze >= need, F.lit(False))),
               F.when(bronze == 0, F.lit("empty (allowed)" if allow_empty else "bronze is empty"))
               .when(need.isNull(), F.lit("source size unknown"))
               .otherwise(F.format_string("bronze=%d, need >= %d", bronze, need)), skip=False),
        decide("silver", "silver_min_rows", ("silver",),
               F.when(silver == 0, F.lit(allow_empty)).otherwise(silver >= F.lit(min_silver_rows)),
               F.when(silver == 0, F.lit("empty (allowed)" if allow_empty else "silver is empty"))
               .otherwise(F.format_string("silver=%d, need >= %d", silver, F.lit(min_silver_rows)))),
        decide("silver", "silver_not_above_bronze", ("bronze", "silver"), ~impossible,
               F.when(impossible, F.format_string("impossible: silver=%d > bronze=%d", silver, bronze))
               .otherwise(F.format_string("silver=%d <= bronze=%d", silver, bronze))),
        _check("dlq", "dlq_threshold", F.col("dlq_error").isNull() & (dead <= F.lit(dlq_max)),
               F.when(F.col("dlq_error").isNotNull(), F.concat(F.lit("dlq unreadable: "), F.col("dlq_error")))
               .otherwise(F.format_string("dlq=%d, max %d", dead, F.lit(dlq_max)))),
    ]
    return w.select(F.inline(F.array(*checks)))


def readiness(snapshots: DataFrame, min_rows: int, allow_empty: bool = False,
              table_col: str = "table", rows_col: str = "rows", ok_col: str = "ok") -> DataFrame:
    """RC6 over polled count snapshots ``(table, rows, ok)``: ready when any good read reached
    ``min_rows``, or, if empty is allowed, when there was a good read and all good ones
    counted zero. Failed reads neither count nor block."""
    good = F.when(F.col(ok_col), F.col(rows_col))
    return snapshots.groupBy(table_col).agg(
        F.coalesce(F.max(good) >= min_rows, F.lit(False)).alias("reached"),
        (F.count(good) > 0).alias("any_read_ok"),
        F.coalesce(F.max(good) == 0, F.lit(False)).alias("always_zero"),
    ).select(table_col, (F.col("reached") | (F.lit(allow_empty) & F.col("any_read_ok")
                                             & F.col("always_zero"))).alias("ready"),
             "reached", "any_read_ok", "always_zero")


def row_accounting(df: DataFrame, filters: Sequence[str], keys: Sequence[str],
                   expected: Mapping[str, int] | None = None, source_rows: int | None = None) -> DataFrame:
    """RC7: bronze rows, rows passing all filters, distinct keys among those
    (= silver rows), and the derived filtered / de-duplicated counts.

    ``expected`` gives counts by those names (``bronze_rows``, ``filtered_rows``, ...)
    and adds ``<name>_as_expected``; ``source_rows`` adds ``produced_complete``, true if at
    least 99 % of the source rows arrived. One key-level aggregation (map-side combined, so
    a hot key ships one partial row per task) followed by a one-row global aggregation.
    """
    ok = filter_condition(filters)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(ok).alias("_ok"))
    out = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("bronze_rows"),
                      F.coalesce(F.sum("_ok"), F.lit(0)).cast("bigint").alias("passing_rows"),
                      F.count_if(F.col("_ok") > 0).cast("bigint").alias("silver_rows"))
    out = out.select(
        "bronze_rows", "passing_rows", "silver_rows",
        (F.col("bronze_rows") - F.col("passing_rows")).alias("filtered_rows"),
        (F.col("passing_rows") - F.col("silver_rows")).alias("deduplicated_rows"))
    for name, rows in (expected or {}).items():
        out = out.withColumn(f"{name}_as_expected", F.col(name) == rows)
    if source_rows is not None:
        out = out.withColumn("produced_complete", F.col("bronze_rows") >= PRODUCED_COMPLETENESS * source_rows)
    return out


# -------------------------------------------------------------- run metrics
METRICS_SCHEMA = T.StructType([
    T.StructField("events", T.LongType()), T.StructField("invalid", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType()), T.StructField("events_per_second", T.DoubleType()),
    T.StructField("mode", T.StringType()), T.StructField("broker", T.StringType()),
    T.StructField("dataset", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("data_path", T.StringType()), T.StructField("produced_at", T.StringType()),
    T.StructField("run_id", T.StringType()), T.StructField("schema_validation", T.BooleanType()),
])


def run_metrics(spark: SparkSession, observed: Mapping[str, int], elapsed_seconds: float, *, mode: str,
                dataset: str, topic: str, data_path: str, run_id: str, broker: str = "",
                schema_validation: bool = False, produced_at: _dt.datetime | None = None) -> DataFrame:
    """RC8: one run-metrics row from the observed counts of a parse or gate
    (``messages``/``events`` and ``rejected``/``invalid``)."""
    events = int(observed.get("events", observed.get("messages", 0)))
    invalid = int(observed.get("invalid", observed.get("rejected", 0)))
    valid = events - invalid
    at = (produced_at or _dt.datetime.now(_dt.UTC)).isoformat()
    row = (valid, invalid, round(elapsed_seconds, 3),
           round(valid / elapsed_seconds, 1) if elapsed_seconds > 0 else 0.0,
           mode, broker, dataset, topic, data_path, at, run_id, schema_validation)
    return spark.createDataFrame([row], METRICS_SCHEMA)


def metrics_trust(metrics: DataFrame, dataset: str, topic: str, data_path: str,
                  now: _dt.datetime | None = None, override: bool = False,
                  max_age_minutes: int = METRICS_MAX_AGE_MIN) -> DataFrame:
    """RC9: whether the newest run-metrics row may be used for count checks:
    produced within ``max_age_minutes`` of ``now`` and for the same dataset,
    topic and data path (a trailing ``Z`` on ``produced_at`` is accepted).
    ``override`` trusts it regardless. Always one check row: no metrics, or a time that cannot
    be read, fail."""
    produced = F.expr("try_to_timestamp(regexp_replace(produced_at, 'Z$', '+00:00'))")
    newest = F.struct(produced.isNotNull().alias("known"), produced.alias("at"), F.col("run_id").alias("run"))
    fields = F.struct(produced.alias("at"), "dataset", "topic", "data_path", "run_id", "produced_at")
    # max_by: one row out of one aggregate, and one row (of NULLs) without any metrics
    latest = metrics.agg(F.count(F.lit(1)).alias("n"), F.max_by(fields, newest).alias("m"))
    m = F.col("m")
    now_c = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    age_min = (F.unix_seconds(now_c) - F.unix_seconds(m["at"])) / 60.0
    fresh = age_min <= max_age_minutes
    same = ((m["dataset"] == dataset) & (m["topic"] == topic) & (m["data_path"] == data_path))
    trusted = (F.col("n") > 0) & (F.lit(override) | (fresh & same))
    msg = (F.when(F.col("n") == 0, F.lit("no run metrics"))
           .when(F.lit(override), F.lit("override: metrics trusted"))
           .when(m["at"].isNull(), F.concat(F.lit("unreadable produced_at: "), F.coalesce(m["produced_at"], F.lit("null"))))
           .when(~fresh, F.format_string("stale: produced %.1f min ago", age_min))
           .when(~F.coalesce(same, F.lit(False)), F.lit("mismatch: dataset/topic/path differ"))
           .otherwise(F.lit("fresh and matching")))
    return latest.select(F.inline(F.array(_check("metrics", "run_metrics_trust", F.coalesce(trusted, F.lit(False)),
                                                 msg, m["run_id"]))))


# --------------------------------------------------------- validation report
STAGES = ("producer", "metrics", "bronze", "silver", "dlq", "marts", "tests")


def validation_report(parts: Sequence[DataFrame]) -> DataFrame:
    """RC10: union of check rows ``(stage, name, passed, message, detail)``
    ordered by pipeline stage, plus an ``overall`` row that passes only if all
    do; a check without an outcome counts as failed.

    The overall row is made from the collected check rows, so the checks are evaluated once.
    """
    allc = parts[0]
    for p in parts[1:]:
        allc = allc.unionByName(p)
    order = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage"))
    each = F.struct("stage", "name", F.coalesce("passed", F.lit(False)).alias("passed"), "message", "detail",
                    order.cast("bigint").alias("stage_order"))
    rows = allc.agg(F.collect_list(each).alias("c"))  # a row per check, of which there are tens
    failed = F.expr("size(filter(c, x -> NOT x.passed))")
    overall = F.struct(F.lit("overall").alias("stage"), F.lit("all_checks").alias("name"),
                       ((failed == 0) & (F.size("c") > 0)).alias("passed"),
                       F.format_string("%d failed", failed).alias("message"), F.lit(None).cast("string").alias("detail"),
                       F.lit(99).cast("bigint").alias("stage_order"))
    return rows.select(F.inline(F.concat(F.col("c"), F.array(overall))))


def checks_as_report(results: DataFrame, stage: str = "tests") -> DataFrame:
    """Data-test results (``checks.RESULT_SCHEMA``) as report rows."""
    return results.select(
        F.lit(stage).alias("stage"),
        F.concat_ws(":", F.col("model"), F.col("check"), F.coalesce(F.col("column"), F.lit(""))).alias("name"),
        F.col("passed"),
        F.format_string("%s: %d failing rows", F.col("status"), F.col("failures")).alias("message"),
        F.col("severity").alias("detail"))
