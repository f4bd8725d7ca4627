"""DuckDB SQL for the registered queries: the independent oracle the driver
runs next to the Spark plans. Written from the operator semantics, not from
the Spark code, over the same driver tables (pre-registered as views).
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"

# ---------------------------------------------------------------- trip chain
SRC = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
src AS (
  SELECT CAST(1 + user_id % 2 AS BIGINT) AS VendorID,
         CASE WHEN event_type <> 'error' THEN ts END AS tpep_pickup_datetime,
         ts + to_seconds(k * 60 + event_id % 60) AS tpep_dropoff_datetime,
         k % 5 AS passenger_count,
         value / 10.0::DOUBLE AS trip_distance,
         1 + k % 6 AS RatecodeID,
         CASE WHEN k % 2 = 0 THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
         CAST(CASE WHEN event_id % 40 = 3 THEN -user_id ELSE user_id END AS BIGINT) AS PULocationID,
         CAST(user_id + k AS BIGINT) AS DOLocationID,
         CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                              WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS BIGINT) AS payment_type,
         value * 0.8::DOUBLE AS fare_amount,
         (k % 3) * 0.5::DOUBLE AS extra,
         0.5::DOUBLE AS mta_tax,
         value * 0.2::DOUBLE AS tip_amount,
         CASE WHEN k % 10 = 0 THEN 6.55::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
         0.3::DOUBLE AS improvement_surcharge,
         value AS total_amount,
         CASE WHEN k % 2 = 0 THEN 2.5::DOUBLE ELSE 0.0::DOUBLE END AS congestion_surcharge,
         CASE WHEN k % 4 = 0 THEN 1.25::DOUBLE ELSE 0.0::DOUBLE END AS Airport_fee,
         event_id
  FROM ev)"""

# Of every 50 messages one is no document, and one has no dropoff time.
BRONZE = SRC + f""",
bronze AS (SELECT * EXCLUDE (event_id) REPLACE (CASE WHEN event_id % 50 <> 1 THEN tpep_dropoff_datetime END AS tpep_dropoff_datetime),
                  {RUN_TS} AS ingestion_ts FROM src WHERE event_id % 50 <> 0)"""

QUALITY = """tpep_pickup_datetime IS NOT NULL
    AND tpep_dropoff_datetime IS NOT NULL
    AND total_amount > 0
    AND trip_distance >= 0
    AND passenger_count >= 0
    AND CAST(tpep_pickup_datetime AS DATE) >= DATE '2024-01-01'
    AND CAST(tpep_pickup_datetime AS DATE) < DATE '2024-02-01'"""

KEY = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
       "DOLocationID", "fare_amount", "total_amount")
OTHER = ("passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag", "payment_type",
         "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
         "congestion_surcharge", "Airport_fee")



def _exact(c: str) -> str:
    """Whole part and fraction in multiples of 2^-62 of a double."""
    return (f"coalesce(CAST(CAST(floor({c}) AS BIGINT) AS VARCHAR) || '.' || "
            f"CAST(CAST(({c} - floor({c})) * 4611686018427387904::DOUBLE AS BIGINT) AS VARCHAR), '')")


TRIP_ID = f"""md5(concat_ws('|',
      coalesce(CAST(VendorID AS VARCHAR), ''),
      coalesce(strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), ''),
      coalesce(strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S.%f'), ''),
      coalesce(CAST(PULocationID AS VARCHAR), ''),
      coalesce(CAST(DOLocationID AS VARCHAR), ''),
      {_exact("fare_amount")},
      {_exact("total_amount")}))"""

SILVER_SELECT = f"""SELECT {TRIP_ID} AS trip_id,
         CAST(VendorID AS INT) AS vendor_id,
         tpep_pickup_datetime AS pickup_datetime,
         tpep_dropoff_datetime AS dropoff_datetime,
         CAST(passenger_count AS INT) AS passenger_count,
         trip_distance AS trip_distance_miles,
         CAST(RatecodeID AS INT) AS rate_code_id,
         store_and_fwd_flag,
         CAST(PULocationID AS INT) AS pickup_location_id,
         CAST(DOLocationID AS INT) AS dropoff_location_id,
         CAST(payment_type AS INT) AS payment_type_id,
         CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount,
         CAST(extra AS DECIMAL(10,2)) AS extra_amount,
         CAST(mta_tax AS DECIMAL(10,2)) AS mta_tax,
         CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
         CAST(tolls_amount AS DECIMAL(10,2)) AS tolls_amount,
         CAST(improvement_surcharge AS DECIMAL(10,2)) AS improvement_surcharge,
         CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
         CAST(congestion_surcharge AS DECIMAL(10,2)) AS congestion_surcharge,
         CAST(Airport_fee AS DECIMAL(10,2)) AS airport_fee,
         ingestion_ts,
         CAST(tpep_pickup_datetime AS DATE) AS pickup_date"""

_ORDER = ", ".join([f"{c} ASC NULLS FIRST" for c in OTHER])
SILVER = BRONZE + f""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(KEY)}
                               ORDER BY ingestion_ts DESC NULLS LAST, {_ORDER}) AS rn
  FROM bronze WHERE {QUALITY}),
silver AS ({SILVER_SELECT} FROM ranked WHERE rn = 1)"""

STG = SILVER + """,
stg AS (
  SELECT trip_id, vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, payment_type_id,
         pickup_datetime, dropoff_datetime, passenger_count, trip_distance_miles, store_and_fwd_flag,
         fare_amount, extra_amount, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         total_amount, congestion_surcharge, airport_fee
  FROM silver WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL)"""

METRICS = STG + """,
m0 AS (SELECT *, datediff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes FROM stg),
metrics AS (
  SELECT trip_id, vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, payment_type_id,
         pickup_datetime, dropoff_datetime, passenger_count, trip_distance_miles, store_and_fwd_flag,
         trip_duration_minutes,
         CASE WHEN trip_duration_minutes > 0
              THEN round(trip_distance_miles / (trip_duration_minutes / 60.0), 2) END AS avg_speed_mph,
         CASE WHEN trip_distance_miles > 0 THEN round(fare_amount / trip_distance_miles, 2) END AS cost_per_mile,
         CASE WHEN fare_amount > 0
              THEN round((CAST(tip_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE)) * 100, 2) END AS tip_percentage,
         CAST(date_trunc('day', pickup_datetime) AS DATE) AS pickup_date,
         extract(hour FROM pickup_datetime) AS pickup_hour,
         dayname(pickup_datetime) AS pickup_day_of_week,
         extract(dow FROM pickup_datetime) IN (0, 6) AS is_weekend,
         fare_amount, extra_amount, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         total_amount, congestion_surcharge, airport_fee
  FROM m0)
, tm AS (SELECT * FROM metrics WHERE trip_duration_minutes BETWEEN 1 AND 720
                               AND (avg_speed_mph IS NULL OR avg_speed_mph < 100))"""

ZONES = """
zones AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS location_id, r.r_name AS borough, n.n_name AS zone_name,
         c.c_mktsegment AS service_zone
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

FCT = METRICS + "," + ZONES + """,
fct AS (
  SELECT t.trip_id, t.vendor_id, t.rate_code_id, t.payment_type_id, t.pickup_location_id,
         t.dropoff_location_id, t.pickup_datetime, t.dropoff_datetime, t.pickup_date, t.pickup_hour,
         t.pickup_day_of_week, t.is_weekend, t.passenger_count, t.trip_distance_miles,
         t.trip_duration_minutes, t.avg_speed_mph, t.cost_per_mile, t.fare_amount, t.extra_amount,
         t.mta_tax, t.tip_amount, t.tip_percentage, t.tolls_amount, t.improvement_surcharge,
         t.total_amount, t.congestion_surcharge, t.airport_fee,
         pu.borough AS pickup_borough, pu.zone_name AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone_name AS dropoff_zone
  FROM tm t LEFT JOIN zones pu ON t.pickup_location_id = pu.location_id
            LEFT JOIN zones dz ON t.dropoff_location_id = dz.location_id)"""

DAILY = METRICS + """,
daily AS (
  SELECT pickup_date, pickup_day_of_week, is_weekend,
         count(*) AS total_trips,
         CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
         round(CAST(sum(CAST(CAST(trip_distance_miles AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(trip_distance_miles), 2) AS avg_trip_distance,
         round(avg(trip_duration_minutes), 2) AS avg_trip_duration_min,
         round(CAST(sum(CAST(CAST(avg_speed_mph AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(avg_speed_mph), 2) AS avg_speed_mph,
         round(sum(fare_amount), 2) AS total_fare_revenue,
         round(sum(tip_amount), 2) AS total_tip_revenue,
         round(sum(total_amount), 2) AS total_revenue,
         round(avg(total_amount), 2) AS avg_trip_revenue,
         round(CAST(sum(CAST(CAST(tip_percentage AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(tip_percentage), 2) AS avg_tip_percentage,
         count(CASE WHEN payment_type_id = 1 THEN 1 END) AS credit_card_trips,
         count(CASE WHEN payment_type_id = 2 THEN 1 END) AS cash_trips
  FROM tm GROUP BY pickup_date, pickup_day_of_week, is_weekend)"""

HOURLY = METRICS + """,
hourly AS (
  SELECT pickup_date, pickup_hour, pickup_day_of_week, is_weekend,
         count(*) AS total_trips,
         round(CAST(sum(CAST(CAST(trip_distance_miles AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(trip_distance_miles), 2) AS avg_distance,
         round(avg(trip_duration_minutes), 2) AS avg_duration_min,
         round(sum(total_amount), 2) AS total_revenue,
         round(avg(total_amount), 2) AS avg_revenue
  FROM tm GROUP BY pickup_date, pickup_hour, pickup_day_of_week, is_weekend)"""

DATES_FROM_BOUNDS = """
dates AS (
  SELECT CAST(d AS DATE) AS date_key,
         extract(year FROM d) AS year, extract(month FROM d) AS month,
         extract(day FROM d) AS day_of_month, extract(dow FROM d) AS day_of_week_num,
         dayname(d) AS day_of_week_name, monthname(d) AS month_name,
         extract(week FROM d) AS week_of_year,
         extract(dow FROM d) IN (0, 6) AS is_weekend,
         CAST(d AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS is_holiday
  FROM bounds, range(bounds.start_d, bounds.end_d, INTERVAL 1 DAY) AS r(d))"""


def w(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip() + "\n" + select


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_pipeline"] = w(SILVER, "SELECT * FROM silver")
    q["stg_trips"] = w(STG, "SELECT * FROM stg")
    q["trip_metrics"] = w(METRICS, "SELECT * FROM tm")
    q["fct_trips"] = w(FCT, "SELECT * FROM fct")
    q["daily_summary"] = w(DAILY, "SELECT * FROM daily")
    q["hourly_patterns"] = w(HOURLY, "SELECT * FROM hourly")
    q["mart_hourly_demand"] = w(HOURLY, """SELECT pickup_hour, is_weekend,
         count(*) AS days_observed,
         round(avg(total_trips), 0) AS avg_trips_per_period,
         round(CAST(sum(CAST(CAST(avg_distance AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(avg_distance), 2) AS avg_distance,
         round(CAST(sum(CAST(CAST(avg_duration_min AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(avg_duration_min), 2) AS avg_duration_min,
         round(avg(total_revenue), 2) AS avg_revenue_per_period,
         CAST(sum(total_trips) AS BIGINT) AS total_trips_all_days
  FROM hourly GROUP BY pickup_hour, is_weekend""")
    q["mart_location_performance"] = w(FCT, """SELECT pickup_location_id, pickup_borough, pickup_zone,
         count(*) AS total_pickups,
         round(CAST(sum(CAST(CAST(trip_distance_miles AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(trip_distance_miles), 2) AS avg_trip_distance,
         round(avg(trip_duration_minutes), 2) AS avg_trip_duration_min,
         round(sum(total_amount), 2) AS total_revenue,
         round(avg(total_amount), 2) AS avg_revenue_per_trip,
         round(CAST(sum(CAST(CAST(tip_percentage AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(tip_percentage), 2) AS avg_tip_pct,
         round(avg(passenger_count), 2) AS avg_passengers,
         mode() WITHIN GROUP (ORDER BY dropoff_zone) AS most_common_dropoff_zone,
         mode() WITHIN GROUP (ORDER BY pickup_hour) AS peak_pickup_hour
  FROM fct WHERE pickup_zone IS NOT NULL
  GROUP BY pickup_location_id, pickup_borough, pickup_zone""")
    bounds = """,
bounds AS (SELECT date_trunc('month', min(ts))::TIMESTAMP AS start_d, CAST(max(ts) AS DATE)::TIMESTAMP - INTERVAL 1 DAY AS end_d FROM events),"""
    q["dim_dates"] = w(METRICS + bounds + DATES_FROM_BOUNDS, "SELECT * FROM dates")
    months = """,
bounds AS (SELECT date_trunc('month', min(ts))::TIMESTAMP AS start_d, date_trunc('month', max(ts))::TIMESTAMP + INTERVAL 1 MONTH AS end_d FROM events),"""
    q["mart_daily_revenue"] = w(DAILY + months + DATES_FROM_BOUNDS, """SELECT d.date_key, d.day_of_week_name,
         d.is_weekend, d.is_holiday, d.week_of_year,
         daily.total_trips, daily.total_passengers, daily.total_fare_revenue, daily.total_tip_revenue,
         daily.total_revenue, daily.avg_trip_revenue, daily.avg_tip_percentage,
         daily.credit_card_trips, daily.cash_trips, daily.avg_trip_distance, daily.avg_trip_duration_min,
         CAST(sum(daily.total_revenue) OVER (ORDER BY d.date_key) AS DECIMAL(38,2)) AS cumulative_revenue,
         CAST(daily.total_revenue - lag(daily.total_revenue) OVER (ORDER BY d.date_key) AS DECIMAL(38,2))
             AS revenue_change_vs_prior_day
  FROM daily JOIN dates d ON daily.pickup_date = d.date_key""")
    q["dim_locations"] = w(ZONES, "SELECT * FROM zones")
    q.update(extra_sql())
    q["mart_location_ranked"] = q["mart_location_performance"]
    q["topic_read"] = q["encode_events"]
    q["silver_table"] = q["silver_pipeline"]
    q["bronze_stream"] = w(BRONZE, "SELECT * EXCLUDE (ingestion_ts) FROM bronze")
    q["upsert_table"] = f"SELECT *, CAST(extract(year FROM o_orderdate) AS INT) AS o_year FROM ({q['upsert_by_key']})"
    q["published"] = w(SRC, """SELECT 'topic' AS topic, coalesce(CAST(PULocationID AS VARCHAR), '') AS key, count(*) AS messages
  FROM src WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 2
UNION ALL SELECT 'dlq', 'tpep_pickup_datetime: null is not of type ''string\'\'', count(*)
  FROM src WHERE tpep_pickup_datetime IS NULL HAVING count(*) > 0""")
    q.update(table_sql(q))
    contracts = ("fct_trips", "dim_dates", "dim_locations", "mart_daily_revenue", "mart_hourly_demand", "mart_location_performance")
    q["contract_check"] = "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS model, 'contract' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(0 AS BIGINT) AS failures,
       'error' AS severity, 'pass' AS status, true AS passed, (SELECT count(*) FROM ({q[name]})) AS rows""" for name in contracts)
    return q


# -------------------------------------------------------------- through tables
def table_sql(q: dict[str, str]) -> dict[str, str]:
    year = "CAST(extract(year FROM o_orderdate) AS INT)"
    return {
        "running_value": """SELECT event_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS running_cents,
       row_number() OVER w AS number
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "row_accounting_merged": q["row_accounting"],
        "late_events": """WITH r AS (SELECT event_id, event_id // 500 AS batch, ts - to_hours(CAST(user_id % 7 AS INT)) AS happened FROM events),
m AS (SELECT batch, max(epoch_us(happened) // 1000) AS ms FROM r GROUP BY batch),
w AS (SELECT batch, greatest(0, coalesce(max(ms) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 10000, 0)) AS mark FROM m)
SELECT event_id, batch, happened, make_timestamp(mark * 1000) AS watermark, happened <= make_timestamp(mark * 1000) AS late FROM r JOIN w USING (batch)""",
        "compacted": "SELECT *, CAST(ts AS DATE) AS day FROM events",
        "upsert_moved": f"""WITH t AS (SELECT *, CASE WHEN o_orderkey % 20 <> 0 THEN {year} END AS o_year FROM orders),
b AS (SELECT * EXCLUDE (o_year) REPLACE ('M' AS o_orderstatus, o_orderdate + INTERVAL 400 DAY AS o_orderdate) FROM t WHERE o_orderkey % 3 = 0)
SELECT * FROM t WHERE o_orderkey % 3 <> 0 UNION ALL SELECT *, CASE WHEN o_orderkey % 15 <> 0 THEN {year} END FROM b""",
        "silver_incremental": f"SELECT * EXCLUDE (ingestion_ts) FROM ({q['silver_pipeline']})",
        "dedup_stream": f"SELECT * EXCLUDE (ingestion_ts) FROM ({q['silver_pipeline']})",
        "latest_wins_stream": f"SELECT * EXCLUDE (ingestion_ts) FROM ({q['silver_pipeline']})",
        "stream_catch_up": f"SELECT * EXCLUDE (ingestion_ts) FROM ({q['silver_pipeline']})",
        "csv_zones": q["dim_locations"],
        "latest_state_stream": f"SELECT * EXCLUDE (ingestion_ts) FROM ({q['silver_pipeline']})",
        "staging_tests": w(SILVER + """,
stg0 AS (SELECT * FROM silver WHERE pickup_datetime IS NOT NULL)""", "\nUNION ALL\n".join(
            [_res("stg_taxi", "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)", "error", "stg0") for c in ("trip_id", "pickup_datetime", "pickup_date")]
            + [_res("stg_taxi", "unique", "trip_id", "count(*)", "error", "(SELECT trip_id FROM stg0 WHERE trip_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")]
            + [_res("stg_taxi", "accepted_range", c, f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({c} {op} 0))", "warn", "stg0")
               for c, op in (("passenger_count", ">="), ("total_amount", ">"), ("trip_distance_miles", ">="))])),
        "dataset_run": w(_layers_cte(), "SELECT layer, CAST(n AS BIGINT) AS rows, true AS ok, CAST(NULL AS VARCHAR) AS message FROM layers WHERE layer <> 'events'"),
        "full_refresh": f"SELECT *, {year} AS o_year FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
        "published_hot": """SELECT CASE WHEN event_id % 2 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS key, count(*) AS messages,
       CASE WHEN key = 'hot' THEN min(event_id) END AS first_id, CASE WHEN key = 'hot' THEN max(event_id) END AS last_id FROM events GROUP BY 1""",
        "table_counts": "\nUNION ALL\n".join(f"SELECT '{t}' AS layer, count(*) AS rows, true AS ok, CAST(NULL AS VARCHAR) AS message FROM {t}"
                                             for t in ("customer", "orders", "lineitem", "events")),
        "stream_run_metrics": """SELECT CAST(count(*) FILTER (WHERE event_id % 50 <> 0) AS BIGINT) AS events,
       CAST(count(*) FILTER (WHERE event_id % 50 = 0) AS BIGINT) AS invalid, true AS trusted FROM events""",
    }


# ------------------------------------------------------------ operator queries
def _res(model: str, check: str, column: str | None, failures: str, severity: str, source: str) -> str:
    col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{model}' AS model, '{check}' AS "check", {col} AS "column",
       CAST(f AS BIGINT) AS failures, '{severity}' AS severity,
       CASE WHEN f = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status,
       (f = 0 OR '{severity}' = 'warn') AS passed
FROM (SELECT {failures} AS f FROM {source})"""


def _orphans(child: str, col: str, parent: str, pcol: str) -> str:
    return (f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col}))")


FILTERS = [f.strip() for f in QUALITY.split("AND")]
# The date filter contains no AND; splitting on AND gives the seven filters.

FCT_CHECKS = [
    ("not_null", "trip_id", "count(*) FILTER (WHERE trip_id IS NULL)", "error"),
    ("accepted_values", "payment_type_id",
     "count(*) FILTER (WHERE payment_type_id IS NOT NULL AND payment_type_id NOT IN (1,2,3,4,5,6))", "warn"),
    ("accepted_range", "trip_duration_minutes",
     "count(*) FILTER (WHERE trip_duration_minutes IS NOT NULL AND NOT (trip_duration_minutes >= 1 "
     "AND trip_duration_minutes <= 720))", "error"),
    ("positive_value", "fare_amount", "count(*) FILTER (WHERE fare_amount < 0)", "error"),
    ("fare_not_exceeds_total", None,
     "count(*) FILTER (WHERE coalesce(total_amount > 0 AND fare_amount > total_amount + 0.01, false))", "error"),
    ("trip_duration_positive", None, "count(*) FILTER (WHERE coalesce(trip_duration_minutes < 0, false))", "error"),
    ("not_null", "pickup_zone", "count(*) FILTER (WHERE pickup_zone IS NULL)", "warn"),
]


def _fct_checks_sql() -> str:
    parts = [_res("fct_trips", c, col, f, sev, "fct") for c, col, f, sev in FCT_CHECKS]
    parts.append(_res("fct_trips", "unique", "trip_id", "count(*)", "error",
                      "(SELECT trip_id FROM fct WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1)"))
    return "\nUNION ALL\n".join(parts)


def _layers_cte() -> str:
    return SILVER + """,
layers AS (
  SELECT 'events' AS layer, count(*) AS n FROM events
  UNION ALL SELECT 'bronze', count(*) FROM bronze
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'dlq', count(*) FILTER (WHERE event_id % 50 = 0) FROM events)"""


def extra_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    li_key = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey"
    q["scan_parquet"] = "SELECT * FROM lineitem"
    q["row_cap"] = f"SELECT * FROM lineitem ORDER BY {li_key} LIMIT 1000"
    iso = "CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END"
    payload = ", ".join(
        f"{c} := {iso.format(c=c) if c in ('tpep_pickup_datetime', 'tpep_dropoff_datetime') else c}"
        for c in KEY[:1] + ("tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                            "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID",
                            "DOLocationID", "payment_type", "fare_amount", "extra", "mta_tax",
                            "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
                            "congestion_surcharge", "Airport_fee"))
    full = SRC + f""",
doc AS (SELECT *, CAST(to_json(struct_pack({payload})) AS VARCHAR) AS json FROM src),
topic AS (SELECT coalesce(CAST(PULocationID AS VARCHAR), '') AS key,
                 CASE WHEN event_id % 50 = 0 THEN left(json, length(json) // 2)
                      WHEN event_id % 50 = 1 THEN regexp_replace(json, ',"tpep_dropoff_datetime":"[^"]*"', '') ELSE json END AS value,
                 CASE WHEN event_id % 50 = 0 THEN 'not a JSON object'
                      WHEN tpep_pickup_datetime IS NULL THEN 'tpep_pickup_datetime: null is not of type \'\'string\'\''
                      WHEN event_id % 50 = 1 THEN '\'\'tpep_dropoff_datetime\'\' is a required property' END AS error, * EXCLUDE (json) FROM doc)"""
    q["encode_events"] = w(full, "SELECT key, value FROM topic")
    q["bronze_parse"] = w(BRONZE, "SELECT * FROM bronze")
    q["schema_gate_valid"] = w(full, f"""SELECT key, {iso.format(c='tpep_pickup_datetime')} AS tpep_pickup_datetime, total_amount
  FROM topic WHERE error IS NULL""")
    q["schema_gate_rejected"] = w(full, "SELECT key, error FROM topic WHERE error IS NOT NULL")
    q["bronze_rejects"] = w(full, "SELECT 'malformed JSON document' AS error, value AS payload FROM topic WHERE event_id % 50 = 0")
    q["dlq_envelope"] = w(full, f"""SELECT error, error AS error_sent, '2024-02-01T00:00:00' AS rejected_at,
       CASE WHEN event_id % 50 <> 0 THEN PULocationID END AS location,
       CASE WHEN event_id % 50 > 1 THEN {iso.format(c='tpep_dropoff_datetime')} END AS dropoff
  FROM topic WHERE error IS NOT NULL""")
    q["readiness"] = """WITH polls AS (
  SELECT event_type AS "table", count(*) FILTER (WHERE value > 250) AS n, max(event_id) % 7 <> 0 AS ok
  FROM events GROUP BY event_type, CAST(ts AS DATE)),
t AS (SELECT "table", max(n) FILTER (WHERE ok) AS top, count(*) FILTER (WHERE ok) AS good FROM polls GROUP BY "table"),
f AS (SELECT "table", coalesce(top >= 5, false) AS reached, good > 0 AS any_read_ok, coalesce(top = 0, false) AS always_zero FROM t)
SELECT "table", reached OR (any_read_ok AND always_zero) AS ready, reached, any_read_ok, always_zero FROM f"""
    q["metrics_trust"] = """WITH runs AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS run_id, CASE WHEN user_id % 3 <> 0 THEN date_trunc('second', max(ts)) END AS made
  FROM events GROUP BY user_id),
newest AS (SELECT * FROM runs ORDER BY made DESC NULLS LAST, run_id DESC LIMIT 1),
aged AS (SELECT *, (epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(made)) / 60.0::DOUBLE AS age FROM newest),
cases AS (SELECT *, 'same' AS "case", true AS same FROM aged UNION ALL SELECT *, 'other dataset', false FROM aged)
SELECT 'metrics' AS stage, 'run_metrics_trust' AS name, coalesce(age <= 1440 AND same, false) AS passed,
       CASE WHEN made IS NULL THEN 'unreadable produced_at: yesterday'
            WHEN age > 1440 THEN printf('stale: produced %.1f min ago', age)
            WHEN NOT same THEN 'mismatch: dataset/topic/path differ' ELSE 'fresh and matching' END AS message,
       run_id AS detail, "case" FROM cases
UNION ALL SELECT 'metrics', 'run_metrics_trust', false, 'no run metrics', CAST(NULL AS VARCHAR), 'no metrics'"""
    q["surrogate_key"] = w(BRONZE, f"SELECT {TRIP_ID} AS trip_id, {', '.join(KEY)} FROM bronze")
    q["quality_filter"] = w(BRONZE, f"SELECT * FROM bronze WHERE {QUALITY}")
    q["silver_project"] = w(BRONZE, f"{SILVER_SELECT} FROM bronze")
    q["dedup_latest"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1"""
    audit = []
    for i, f in enumerate(FILTERS):
        earlier = " AND ".join(f"coalesce({g}, false)" for g in FILTERS[:i]) or "true"
        audit.append(f"""SELECT {i + 1} AS position, '{f.replace("'", "''")}' AS rule,
       count(*) FILTER (WHERE NOT coalesce({f}, false)) AS failing_rows,
       count(*) FILTER (WHERE ({earlier}) AND NOT coalesce({f}, false)) AS first_failing_rows,
       count(*) AS total_rows FROM bronze""")
    q["rule_audit"] = w(BRONZE, "\nUNION ALL\n".join(audit))
    rng = [("passenger_count", "passenger_count >= 0"), ("total_amount", "total_amount > 0"),
           ("trip_distance_miles", "trip_distance_miles >= 0")]
    q["derived_range_checks"] = w(SILVER, "\nUNION ALL\n".join(
        _res("silver", "accepted_range", c, f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({cond}))",
             "warn", "silver") for c, cond in rng))
    q["mart_stub"] = w(SILVER, "SELECT * FROM silver WHERE pickup_datetime IS NOT NULL")
    q["stg_generic"] = w(SILVER, "SELECT * FROM silver WHERE pickup_datetime IS NOT NULL")
    pay_case = ("CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 "
                "WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END")
    q["dim_payment_types"] = f"""SELECT DISTINCT CAST({pay_case} AS INT) AS payment_type_id,
       event_type AS payment_type_name FROM events"""
    q["dim_rate_codes"] = "SELECT CAST(r_regionkey + 1 AS INT) AS rate_code_id, r_name AS rate_code_name FROM region"
    q["dim_vendors"] = """SELECT s_suppkey AS vendor_id, s_name AS vendor_name,
       'V' || CAST(s_suppkey AS VARCHAR) AS vendor_abbr FROM supplier"""
    q["stg_lookups"] = w(ZONES, f"""SELECT 'zones' AS lookup, location_id AS id, zone_name AS name, borough AS attribute FROM zones
UNION ALL SELECT DISTINCT 'payment_types', CAST({pay_case} AS BIGINT), event_type, CAST(NULL AS VARCHAR) FROM events
UNION ALL SELECT 'rate_codes', CAST(r_regionkey + 1 AS BIGINT), r_name, CAST(NULL AS VARCHAR) FROM region
UNION ALL SELECT 'vendors', s_suppkey, s_name, 'V' || CAST(s_suppkey AS VARCHAR) FROM supplier""")
    q["duration_minutes"] = w(STG, """SELECT trip_id, pickup_datetime, dropoff_datetime,
       datediff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes FROM stg""")
    q["mode_per_group"] = w(METRICS, """SELECT pickup_location_id,
       mode() WITHIN GROUP (ORDER BY pickup_hour) AS peak_pickup_hour
  FROM tm WHERE pickup_hour IS NOT NULL GROUP BY pickup_location_id""")
    split = """target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
batch AS (SELECT * REPLACE ('F' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""
    q["upsert_by_key"] = w(split, """SELECT * FROM target t
  WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM batch""")
    q["incremental_filter"] = w(split, "SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM target)")
    q["run_checks"] = w(FCT, _fct_checks_sql())
    q["unique_check"] = "\nUNION ALL\n".join([
        _res("orders", "unique", "o_orderkey", "count(*)", "error",
             "(SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
        _res("lineitem", "unique", "l_orderkey", "count(*)", "warn",
             "(SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")])
    q["accepted_values_check"] = "\nUNION ALL\n".join([
        _res("events", "accepted_values", "event_type",
             "count(*) FILTER (WHERE event_type IS NOT NULL AND event_type NOT IN ('click','view','purchase','signup'))",
             "warn", "events"),
        _res("orders", "accepted_values", "o_orderstatus",
             "count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O','F','P'))",
             "error", "orders")])
    q["accepted_range_check"] = "\nUNION ALL\n".join([
        _res("events", "accepted_range", "value",
             "count(*) FILTER (WHERE value IS NOT NULL AND NOT (value >= 0 AND value <= 400))", "warn", "events"),
        _res("lineitem", "accepted_range", "l_discount",
             "count(*) FILTER (WHERE l_discount IS NOT NULL AND NOT (l_discount >= 0 AND l_discount <= 0.1))",
             "error", "lineitem"),
        _res("lineitem", "accepted_range", "l_quantity",
             "count(*) FILTER (WHERE l_quantity IS NOT NULL AND NOT (l_quantity > 0 AND l_quantity < 50))",
             "warn", "lineitem")])
    q["relationship_check"] = w(METRICS + "," + ZONES, "\nUNION ALL\n".join([
        _res("orders", "relationships:c_custkey", "o_custkey",
             _orphans("orders", "o_custkey", "customer", "c_custkey"), "error", "orders c"),
        _res("lineitem", "relationships:p_partkey", "l_partkey",
             _orphans("lineitem", "l_partkey", "part", "p_partkey"), "error", "lineitem c"),
        _res("trip_metrics", "relationships:location_id", "pickup_location_id",
             _orphans("tm", "pickup_location_id", "zones", "location_id"), "warn", "tm c"),
        _res("trip_metrics", "relationships:location_id", "dropoff_location_id",
             _orphans("tm", "dropoff_location_id", "zones", "location_id"), "warn", "tm c")]))
    q["freshness"] = """SELECT 'events' AS source, max_loaded_at,
       round(CAST(epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max_loaded_at) AS DOUBLE)
             / 3600000000.0::DOUBLE, 3) AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN CAST(epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max_loaded_at) AS DOUBLE)
                 / 3600000000.0::DOUBLE > 48 THEN 'error'
            WHEN CAST(epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max_loaded_at) AS DOUBLE)
                 / 3600000000.0::DOUBLE > 24 THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT max(ts) AS max_loaded_at FROM events)"""
    q["layer_counts"] = w(_layers_cte(), """SELECT layer, CAST(n AS BIGINT) AS rows, true AS ok,
       CAST(NULL AS VARCHAR) AS message FROM layers""")
    q["row_accounting"] = """SELECT bronze_rows, passing_rows, silver_rows,
       bronze_rows - passing_rows AS filtered_rows, passing_rows - silver_rows AS deduplicated_rows
FROM (SELECT count(*) AS bronze_rows,
             count(*) FILTER (WHERE l_quantity > 0 AND l_discount <= 0.08
                              AND l_shipdate >= DATE '1996-01-01') AS passing_rows,
             count(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE l_quantity > 0 AND l_discount <= 0.08
                              AND l_shipdate >= DATE '1996-01-01') AS silver_rows
      FROM lineitem)"""
    q["validation_report"] = w(FCT + """,
layers AS (
  SELECT 'events' AS layer, count(*) AS n FROM events
  UNION ALL SELECT 'bronze', count(*) FROM bronze
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'dlq', count(*) FILTER (WHERE event_id % 50 = 0) FROM events),
lw AS (SELECT max(n) FILTER (WHERE layer = 'bronze') AS bronze, max(n) FILTER (WHERE layer = 'silver') AS silver,
              max(n) FILTER (WHERE layer = 'dlq') AS dlq, max(n) FILTER (WHERE layer = 'events') AS events FROM layers),
need AS (SELECT *, CAST(floor(CAST(events AS DOUBLE) * 0.95::DOUBLE) AS BIGINT) AS need FROM lw),
chk AS (""" + _fct_checks_sql() + """),
decisions AS (
  SELECT 'bronze' AS stage, 'bronze_completeness' AS name,
         CASE WHEN bronze = 0 THEN false ELSE bronze >= need END AS passed,
         CASE WHEN bronze = 0 THEN 'bronze is empty' ELSE printf('bronze=%d, need >= %d', bronze, need) END AS message,
         CAST(NULL AS VARCHAR) AS detail FROM need
  UNION ALL
  SELECT 'silver', 'silver_min_rows', CASE WHEN silver = 0 THEN false ELSE silver >= 1 END,
         CASE WHEN silver = 0 THEN 'silver is empty' ELSE printf('silver=%d, need >= %d', silver, 1) END, NULL FROM lw
  UNION ALL
  SELECT 'silver', 'silver_not_above_bronze', silver <= greatest(bronze, 1),
         CASE WHEN silver <= greatest(bronze, 1) THEN printf('silver=%d <= bronze=%d', silver, bronze)
              ELSE printf('impossible: silver=%d > bronze=%d', silver, bronze) END, NULL FROM lw
  UNION ALL
  SELECT 'dlq', 'dlq_threshold', coalesce(dlq, 0) <= 0, printf('dlq=%d, max %d', coalesce(dlq, 0), 0), NULL FROM lw),
tests AS (
  SELECT 'tests' AS stage, concat_ws(':', model, "check", coalesce("column", '')) AS name, passed,
         printf('%s: %d failing rows', status, failures) AS message, severity AS detail FROM chk),
allc AS (SELECT * FROM decisions UNION ALL SELECT * FROM tests)""", """SELECT *, CAST(CASE stage WHEN 'producer' THEN 1 WHEN 'metrics' THEN 2 WHEN 'bronze' THEN 3
       WHEN 'silver' THEN 4 WHEN 'dlq' THEN 5 WHEN 'marts' THEN 6 WHEN 'tests' THEN 7 END AS BIGINT) AS stage_order
FROM allc
UNION ALL
SELECT 'overall', 'all_checks', coalesce(bool_and(passed), false),
       printf('%d failed', count(*) FILTER (WHERE NOT passed)), CAST(NULL AS VARCHAR), CAST(99 AS BIGINT) FROM allc""")
    return q
