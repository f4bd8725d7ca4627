"""Certification counts: rows through Bronze and Silver, and row accounting."""

from certdata import RAW_SCHEMA, clean_set, edge_set

from stratum.operators import checks as ck
from stratum.operators import reconcile
from stratum.operators.parsing import encode_events, parse_events
from stratum.operators.silver import silver


def _bronze(spark, rows, taxi):
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    return parse_events(encode_events(df, taxi), taxi, ingestion_ts="2024-02-01 00:00:00").rows


def test_clean_set(spark, taxi):
    b = _bronze(spark, clean_set(), taxi)
    assert b.count() == 1000
    assert silver(b, taxi).count() == 1000


def test_edge_set_counts(spark, taxi):
    rows, want = edge_set(taxi.quality_filters)
    b = _bronze(spark, rows, taxi)
    assert b.count() == want["bronze"] == 77
    s = silver(b, taxi)
    assert s.count() == want["silver"] == 50
    acc = reconcile.row_accounting(b, taxi.quality_filters, taxi.dedup_key).first()
    assert (acc.bronze_rows, acc.passing_rows, acc.silver_rows) == (77, 70, 50)
    assert acc.filtered_rows == 7 and acc.deduplicated_rows == 20


def test_rule_audit_first_failing_sums_to_dropped(spark, taxi):
    rows, _ = edge_set(taxi.quality_filters)
    audit = ck.rule_audit(_bronze(spark, rows, taxi), taxi.quality_filters).collect()
    assert sum(r.first_failing_rows for r in audit) == 7
    # one NULL pickup fails its not-null filter and, by 3-valued logic, both date bounds
    by_rule = {r.rule: r.failing_rows for r in audit}
    assert by_rule["CAST(tpep_pickup_datetime AS DATE) >= DATE '2024-01-01'"] == 2


def test_silver_key_is_stable_across_replays(spark, taxi):
    rows, _ = edge_set(taxi.quality_filters)
    first = _bronze(spark, rows, taxi)
    again = parse_events(encode_events(spark.createDataFrame(rows, RAW_SCHEMA), taxi), taxi,
                         ingestion_ts="2024-02-02 00:00:00").rows
    s1 = silver(first, taxi).select("trip_id")
    s2 = silver(first.unionByName(again), taxi).select("trip_id")
    assert sorted(r[0] for r in s1.collect()) == sorted(r[0] for r in s2.collect())


def test_accounting_against_expected_counts(spark, taxi):
    rows, want = edge_set(taxi.quality_filters)
    expected = {"bronze_rows": want["bronze"], "silver_rows": want["silver"], "filtered_rows": want["filtered"], "deduplicated_rows": want["deduplicated"]}
    acc = reconcile.row_accounting(_bronze(spark, rows, taxi), taxi.quality_filters, taxi.dedup_key, expected, source_rows=77).first()
    assert all(acc[f"{k}_as_expected"] for k in expected) and acc.produced_complete
    short = reconcile.row_accounting(_bronze(spark, rows, taxi), taxi.quality_filters, taxi.dedup_key, source_rows=78).first()
    assert not short.produced_complete
