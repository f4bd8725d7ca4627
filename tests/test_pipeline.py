from certdata import RAW_SCHEMA, edge_set
from stratum import manifest as mf
from stratum.plans import pipeline
from stratum.sinks.tables import layer_path


def test_run_pipeline_end_to_end_and_rerun(spark, taxi, tmp):
    rows, want = edge_set(taxi.quality_filters)
    src = spark.createDataFrame(rows, RAW_SCHEMA)
    zones = spark.createDataFrame([(i, "B", f"Z{i}", "S") for i in range(1, 200)],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    res = pipeline.run_pipeline(spark, taxi, tmp, source=src, zones_csv=zones)
    counts = {r.layer: r.rows for r in res.counts.collect()}
    assert counts["bronze"] == want["bronze"] and counts["silver"] == want["silver"]
    assert counts["dlq"] == 0
    report = res.report.collect()
    assert [r for r in report if r.stage == "overall"]
    assert spark.read.parquet(res.tables["mart_location_performance"]).count() > 0
    # replay the same topic again: Bronze doubles, Silver does not change
    silver_before = sorted(r.trip_id for r in spark.read.parquet(res.tables["silver"]).collect())
    pipeline.run_pipeline(spark, taxi, tmp, steps=("bronze",))
    assert spark.read.parquet(res.tables["bronze"]).count() == 2 * want["bronze"]
    pipeline.run_pipeline(spark, taxi, tmp, steps=("silver",))  # Bronze stays as it is
    assert spark.read.parquet(res.tables["bronze"]).count() == 2 * want["bronze"]
    silver_after = sorted(r.trip_id for r in spark.read.parquet(res.tables["silver"]).collect())
    assert silver_after == silver_before


def test_touched_dates_rebuild(spark, taxi, tmp):
    assert pipeline.date_follows_key(taxi)
    rows, _ = edge_set(taxi.quality_filters)
    topic = lambda rs: __import__("stratum.operators.parsing", fromlist=["x"]).encode_events(
        spark.createDataFrame(rs, RAW_SCHEMA), taxi)
    pipeline.run_dataset(spark, taxi, topic(rows[:40]), tmp, ingestion_ts="2024-02-01 00:00:00")
    pipeline.run_dataset(spark, taxi, topic(rows[40:]), tmp, ingestion_ts="2024-02-02 00:00:00")
    incremental = spark.read.parquet(layer_path(tmp, taxi.silver_table))
    from stratum.operators.silver import silver

    full = silver(spark.read.parquet(layer_path(tmp, taxi.bronze_table)), taxi)
    cols = [c for c in incremental.columns]
    assert sorted(map(tuple, incremental.select(cols).collect()), key=str) == \
        sorted(map(tuple, full.select(cols).collect()), key=str)


def test_generic_manifest_runs(spark, tmp):
    orders = mf.builtin("orders")
    assert pipeline.date_follows_key(orders)
    src = spark.createDataFrame([("2024-01-01T10:00:00", 5.0, 1), ("2024-01-01T10:00:00", 5.0, 1),
                                 ("2024-01-02T11:00:00", -1.0, 2)], "event_ts string, amount double, quantity long")
    from stratum.operators.parsing import encode_events

    res = pipeline.run_dataset(spark, orders, encode_events(src, orders), tmp)
    assert {r.layer: r.rows for r in res.counts.collect()} == {"bronze": 3, "silver": 1, "dlq": 0}
    checks = {(r.check, r.column): r.status for r in res.checks.collect()}
    assert checks[("not_null", "orders_id")] == "pass" and checks[("unique", "orders_id")] == "pass"
    assert checks[("accepted_range", "amount")] == "pass"


def test_validate_step_reports_the_tables_as_they_are(spark, taxi, tmp):
    rows, want = edge_set(taxi.quality_filters)
    src = spark.createDataFrame(rows, RAW_SCHEMA)
    zones = spark.createDataFrame([(i, "B", f"Z{i}", "S") for i in range(1, 200)],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    res = pipeline.run_pipeline(spark, taxi, tmp, source=src, zones_csv=zones)
    report = {r.name: r for r in res.report.collect()}
    assert report["bronze_completeness"].passed and report["run_metrics_trust"].passed
    assert any(r.stage == "marts" and "contract" in r.name and r.passed for r in report.values())
    assert report["all_checks"].passed
    assert {"dim_dates", "mart_daily_revenue", "fct_trips", "dim_locations"} <= set(res.tables)
    again = {r.name: r for r in pipeline.run_pipeline(spark, taxi, tmp, steps=("validate",), events=10_000).report.collect()}
    assert not again["bronze_completeness"].passed and not again["all_checks"].passed
    empty = {r.name: r for r in pipeline.validate(spark, taxi, f"{tmp}/none").report.collect()}
    assert not empty["all_checks"].passed and empty["run_metrics_trust"].message == "no run metrics"


def test_incremental_marts_equal_a_rebuild(spark, taxi, tmp):
    from certdata import clean_set

    from stratum.operators.parsing import encode_events

    zones = spark.createDataFrame([(i, "B", f"Z{i}", "S") for i in range(1, 200)],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    rows = sorted(clean_set(200), key=lambda r: r["tpep_pickup_datetime"])
    for i, part in enumerate((rows[:120], rows[120:])):
        pipeline.run_dataset(spark, taxi, encode_events(spark.createDataFrame(part, RAW_SCHEMA), taxi), tmp, ingestion_ts=f"2024-02-0{i + 1} 00:00:00")
        silver = spark.read.parquet(layer_path(tmp, taxi.silver_table))
        step = pipeline.run_trip_marts(spark, silver, zones, f"{tmp}/step", incremental=True, lookback="1 hour")
    whole = pipeline.run_trip_marts(spark, silver, zones, f"{tmp}/whole")
    for name in ("fct_trips", "mart_daily_revenue", "mart_location_performance"):
        a, b = spark.read.parquet(step[name]), spark.read.parquet(whole[name])
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect())), name


def test_lookups_become_dimensions(spark, taxi, tmp):
    from stratum.operators.parsing import encode_events

    rows, _ = edge_set(taxi.quality_filters)
    pipeline.run_dataset(spark, taxi, encode_events(spark.createDataFrame(rows, RAW_SCHEMA), taxi), tmp)
    zones = spark.createDataFrame([(1, "B", "Z", "S")], "LocationID int, Borough string, Zone string, service_zone string")
    lookups = {"payment_types": spark.createDataFrame([(1, "card")], "payment_type_id int, payment_type_name string"),
               "vendors": spark.createDataFrame([(1, "v", "V")], "vendor_id int, vendor_name string, vendor_abbr string")}
    out = pipeline.run_trip_marts(spark, spark.read.parquet(layer_path(tmp, taxi.silver_table)), zones, tmp, lookups=lookups)
    assert spark.read.parquet(out["dim_payment_types"]).count() == 1 and spark.read.parquet(out["dim_vendors"]).count() == 1
