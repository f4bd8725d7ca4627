import datetime as dt

from pyspark.sql import functions as F

from stratum import manifest as mf
from stratum.operators import checks as ck
from stratum.operators import reconcile


def _m(filters, extra_cols=()):
    return mf.from_dict({
        "manifest_version": 1, "name": "orders", "topic": "t", "dlq_topic": "d",
        "bronze_table": "bronze.o", "silver_table": "silver.o", "event_ts_col": "event_ts",
        "ts_format": "yyyy-MM-dd'T'HH:mm:ss", "partition_date_col": "d",
        "partition_date_expr": "CAST(event_ts AS DATE)",
        "columns": [{"name": "event_ts", "kafka_type": "STRING", "bronze_type": "TIMESTAMP(3)",
                     "silver_type": "TIMESTAMP(3)", "is_event_ts": True},
                    {"name": "amount", "kafka_type": "DOUBLE", "bronze_type": "DOUBLE",
                     "silver_name": "amount_usd", "silver_type": "DECIMAL(10,2)"},
                    {"name": "qty", "kafka_type": "BIGINT", "bronze_type": "BIGINT", "silver_type": "INT"},
                    {"name": "note", "kafka_type": "STRING", "bronze_type": "STRING", "silver_type": "STRING"},
                    *extra_cols],
        "dedup_key": ["event_ts"], "surrogate_key_fields": ["event_ts"], "quality_filters": filters})


def test_derived_ranges_tightest_bounds():
    m = _m(["amount >= 0", "amount > 0", "amount <= 100", "amount < 100", "qty >= 1",
            "note > 3", "event_ts IS NOT NULL", "qty >= 0.5 + 1"])
    got = {c.column: (c.min_value, c.max_value, c.inclusive) for c in ck.derived_range_checks(m)}
    assert got == {"amount_usd": (0, 100, False), "qty": (1, None, True)}
    assert [c.column for c in ck.derived_range_checks(m)] == ["amount_usd", "qty"]


def test_row_checks_one_pass(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (None, "z", -1.0), (3, "b", 50.0)], "id int, v string, x double")
    res = {(r.check, r.column): r for r in ck.run_checks(df, [
        ck.not_null("id"), ck.accepted_values("v", ["a", "b"], severity="warn"),
        ck.accepted_range("x", 0, 10), ck.positive_value("x"), ck.unique("v")], "t").collect()}
    assert res[("not_null", "id")].failures == 1 and not res[("not_null", "id")].passed
    assert res[("accepted_values", "v")].status == "warn" and res[("accepted_values", "v")].passed
    assert res[("accepted_range", "x")].failures == 2
    assert res[("positive_value", "x")].failures == 1
    assert res[("unique", "v")].failures == 0


def test_readiness_rules(spark):
    snaps = spark.createDataFrame([("a", 0, True), ("a", 5, True), ("b", 0, True), ("b", 0, True),
                                   ("c", 0, True), ("c", -1, False)], "table string, rows long, ok boolean")
    strict = {r.table: r.ready for r in reconcile.readiness(snaps, 1).collect()}
    lenient = {r.table: r.ready for r in reconcile.readiness(snaps, 1, allow_empty=True).collect()}
    assert strict == {"a": True, "b": False, "c": False}
    assert lenient == {"a": True, "b": True, "c": True}  # one failed poll does not block
    failed = spark.createDataFrame([("d", 0, False), ("e", 7, False)], "table string, rows long, ok boolean")
    assert not any(r.ready for r in reconcile.readiness(failed, 1, allow_empty=True).collect())


def test_layer_decisions(spark):
    counts = spark.createDataFrame([("events", 100, True, None), ("bronze", 96, True, None),
                                    ("silver", 0, True, None)], reconcile.COUNT_SCHEMA)
    got = {r.name: r.passed for r in reconcile.layer_decisions(counts).collect()}
    assert got["bronze_completeness"] and not got["silver_min_rows"] and got["dlq_threshold"]
    got = {r.name: r.passed for r in reconcile.layer_decisions(counts, allow_empty=True).collect()}
    assert got["silver_min_rows"]
    impossible = spark.createDataFrame([("bronze", 5, True, None), ("silver", 9, True, None)],
                                       reconcile.COUNT_SCHEMA)
    got = {r.name: r for r in reconcile.layer_decisions(impossible, events=5).collect()}
    assert not got["silver_not_above_bronze"].passed
    assert got["silver_not_above_bronze"].message.startswith("impossible")


def test_metrics_trust(spark):
    now = dt.datetime(2024, 2, 1, 12, 0)
    rows = [(100, 0, 1.0, 100.0, "burst", "b", "taxi", "taxi.trips", "/d", "2024-02-01T11:00:00Z", "r1", False)]
    m = spark.createDataFrame(rows, reconcile.METRICS_SCHEMA)
    ok = reconcile.metrics_trust(m, "taxi", "taxi.trips", "/d", now=now).first()
    assert ok.passed and ok.message == "fresh and matching"
    stale = reconcile.metrics_trust(m, "taxi", "taxi.trips", "/d", now=now + dt.timedelta(hours=3)).first()
    assert not stale.passed and stale.message.startswith("stale")
    other = reconcile.metrics_trust(m, "orders", "taxi.trips", "/d", now=now).first()
    assert not other.passed and other.message.startswith("mismatch")
    assert reconcile.metrics_trust(m, "orders", "x", "/y", now=now, override=True).first().passed
    none = reconcile.metrics_trust(m.limit(0), "taxi", "taxi.trips", "/d", now=now).collect()
    assert [(r.passed, r.message) for r in none] == [(False, "no run metrics")]
    bad = spark.createDataFrame([(*rows[0][:9], "not a time", "r2", False)], reconcile.METRICS_SCHEMA)
    r = reconcile.metrics_trust(bad, "taxi", "taxi.trips", "/d", now=now).first()
    assert not r.passed and r.message == "unreadable produced_at: not a time"
    both = reconcile.metrics_trust(bad.unionByName(m), "taxi", "taxi.trips", "/d", now=now).first()
    assert both.passed and both.detail == "r1"  # the newest readable time counts


def test_layer_counts_unreadable_path(spark, tmp):
    df = reconcile.layer_counts(spark, {"bronze": spark.range(3), "silver": f"{tmp}/missing"})
    got = {r.layer: (r.rows, r.ok) for r in df.collect()}
    assert got == {"bronze": (3, True), "silver": (-1, False)}


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "loaded_at timestamp_ntz")
    r = ck.freshness(df, "loaded_at", now=dt.datetime(2024, 1, 2, 6)).first()
    assert r.age_hours == 30.0 and r.status == "warn"
    assert ck.freshness(df, "loaded_at", now=dt.datetime(2024, 1, 3, 1)).first().status == "error"
    assert ck.freshness(df.filter(F.lit(False)), "loaded_at").first().status == "error"


def test_unknown_or_unreadable_layers_fail(spark):
    def decide(*layers, **kw):
        frame = spark.createDataFrame([(*x, None)[:4] if len(x) == 3 else x for x in layers], reconcile.COUNT_SCHEMA)
        return {r.name: (r.passed, r.message) for r in reconcile.layer_decisions(frame, **kw).collect()}

    good = [("bronze", 100, True), ("silver", 90, True)]
    assert decide(*good)["bronze_completeness"] == (False, "source size unknown")
    assert decide(*good, events=100)["bronze_completeness"][0]
    broken = decide(("bronze", 100, True), ("silver", -1, False, "no such file"), ("dlq", -1, False, "gone"), events=100)
    assert broken["silver_min_rows"] == (False, "silver unreadable: no such file")
    assert not broken["silver_not_above_bronze"][0] and broken["dlq_threshold"] == (False, "dlq unreadable: gone")
    skipped = decide(("bronze", 0, True), ("silver", 0, True), events=0, allow_empty=True)
    assert skipped["bronze_completeness"][0] and skipped["silver_min_rows"] == (True, "skipped: bronze is empty (allowed)")
    assert not decide(("bronze", 0, True), ("silver", 0, True), events=0)["bronze_completeness"][0]


def test_report_counts_a_missing_outcome_as_failed(spark):
    rows = [("bronze", "a", True, "", None), ("silver", "b", None, "", None)]
    out = {r.name: (r.passed, r.message) for r in reconcile.validation_report([spark.createDataFrame(rows, reconcile.CHECK_SCHEMA)]).collect()}
    assert out["b"][0] is False and out["all_checks"] == (False, "1 failed")


def test_whole_error_text(spark, tmp):
    r = reconcile.layer_counts(spark, {"silver": f"{tmp}/{'x' * 400}"}).first()
    assert "x" * 400 in r.message


def test_contracts(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    ok = ck.contract_check(df, "id INT, name STRING", "m").first()
    assert ok.passed and ok.failures == 0
    bad = ck.contract_check(df, "id BIGINT, other STRING", "m").first()
    assert not bad.passed and bad.failures == 3 and set(bad.column.split(",")) == {"other", "name", "id"}
