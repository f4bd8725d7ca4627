import json

from pyspark.sql import functions as F

from stratum.operators import parsing


def test_bad_document_rejected_bad_field_nulled(spark, taxi):
    msgs = spark.createDataFrame([
        ('{"VendorID": 1, "tpep_pickup_datetime": "2024-01-02T10:00:00", "total_amount": 5.5}',),
        ('{"VendorID": "x", "tpep_pickup_datetime": "2024-01-02 10:00:00"}',),
        ("not json at all",),
        ("[1, 2]",),
    ], "value string")
    p = parsing.parse_events(msgs, taxi, ingestion_ts="2024-02-01 00:00:00")
    rows = p.rows.orderBy("total_amount").collect()
    assert len(rows) == 2
    bad = [r for r in rows if r.total_amount is None][0]
    assert bad.VendorID is None and bad.tpep_pickup_datetime is None  # space separator does not parse
    good = [r for r in rows if r.total_amount == 5.5][0]
    assert str(good.tpep_pickup_datetime) == "2024-01-02 10:00:00"
    assert p.rejects.count() == 2


def test_encode_keeps_nulls_and_zero_key(spark, taxi):
    df = spark.createDataFrame([(0, None)], "PULocationID bigint, store_and_fwd_flag string")
    row = parsing.encode_events(df, taxi).first()
    assert row.key == "0"
    assert json.loads(row.value) == {"PULocationID": 0, "store_and_fwd_flag": None}


def test_schema_gate_messages(spark):
    schema = {"properties": {"a": {"type": ["integer", "null"]}, "t": {"type": "string"}},
              "required": ["t"]}
    msgs = spark.createDataFrame([('{"a": 1, "t": "x"}',), ('{"a": 1.5, "t": "x"}',), ('{"a": 2}',),
                                  ('{"t": null}',), ("oops",), ('{"a": 3.0, "t": "y"}',)], "value string")
    got = {r.value: r.error for r in parsing.schema_gate(msgs, schema).collect()}
    assert got['{"a": 1, "t": "x"}'] is None
    assert got['{"a": 1.5, "t": "x"}'] == "a: number is not of type 'integer', 'null'"
    assert got['{"a": 2}'] == "'t' is a required property"
    assert got['{"t": null}'] == "t: null is not of type 'string'"
    assert got["oops"] == "not a JSON object"
    assert got['{"a": 3.0, "t": "y"}'] is None  # whole numbers count as integers


def test_dlq_envelope(spark):
    rej = spark.createDataFrame([('{"a": 1}', "boom"), ("oops", "bad")], "value string, error string")
    env = [json.loads(r.value) for r in parsing.dlq_envelope(rej, at="2024-02-01 00:00:00").collect()]
    assert env[0] == {"error": "boom", "row": {"a": 1}, "timestamp": "2024-02-01T00:00:00"}
    assert env[1]["row"] == "oops"


def test_parse_run_metrics(spark, taxi):
    from pyspark.sql import Observation

    from stratum.operators import reconcile

    obs = Observation("parse")
    msgs = spark.createDataFrame([('{"VendorID": 1}',), ("garbage",), ('{"VendorID": 2}',)], "value string")
    p = parsing.parse_events(msgs, taxi, observation=obs)
    assert p.rows.count() == 2
    assert obs.get == {"messages": 3, "rejected": 1}
    row = reconcile.run_metrics(spark, obs.get, 2.0, mode="batch", dataset="taxi", topic="t",
                                data_path="/d", run_id="r1").first()
    assert (row.events, row.invalid, row.events_per_second) == (2, 1, 1.0)


def test_fraction_of_a_second_survives(spark, taxi):
    msgs = spark.createDataFrame([(f'{{"tpep_pickup_datetime": "2024-01-02T10:00:00{f}"}}',) for f in ("", ".5", ".250000")], "value string")
    got = sorted(str(r.tpep_pickup_datetime) for r in parsing.parse_events(msgs, taxi).rows.collect())
    assert got == ["2024-01-02 10:00:00", "2024-01-02 10:00:00.250000", "2024-01-02 10:00:00.500000"]


def test_property_names_are_taken_literally(spark):
    schema = {"properties": {"a.b": {"type": "integer"}}, "required": ["a.b"]}
    msgs = spark.createDataFrame([('{"a.b": 1}',), ('{"a": {"b": 1}}',)], "value string")
    got = {r.value: r.error for r in parsing.schema_gate(msgs, schema).collect()}
    assert got == {'{"a.b": 1}': None, '{"a": {"b": 1}}': "'a.b' is a required property"}


def test_partition_date_by_format(spark):
    import dataclasses

    from stratum import manifest as mf
    from stratum.operators.silver import silver_project

    m = dataclasses.replace(mf.builtin("orders"), partition_date_expr="to_date(date_format(event_ts, 'yyyy-MM-dd'))")
    msgs = spark.createDataFrame([('{"event_ts": "2024-03-04T05:06:07", "amount": 1.5, "quantity": 2}',)], "value string")
    row = silver_project(parsing.parse_events(msgs, m).rows, m).first()
    assert str(row[m.partition_date_col]) == "2024-03-04"
