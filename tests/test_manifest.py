import pytest
from pyspark.sql import types as T

from stratum import manifest as mf


def _base():
    return {
        "manifest_version": 1, "name": "orders", "topic": "t", "dlq_topic": "t.dlq",
        "bronze_table": "bronze.raw_orders", "silver_table": "silver.orders", "event_ts_col": "event_ts",
        "ts_format": "yyyy-MM-dd''T''HH:mm:ss", "partition_date_col": "event_date",
        "partition_date_expr": "CAST(event_ts AS DATE)",
        "columns": [
            {"name": "event_ts", "kafka_type": "STRING", "bronze_type": "TIMESTAMP(3)",
             "silver_type": "TIMESTAMP(3)", "is_event_ts": True},
            {"name": "amount", "kafka_type": "DOUBLE", "bronze_type": "DOUBLE", "silver_type": "DECIMAL(10,2)"},
        ],
        "dedup_key": ["event_ts", "amount"], "surrogate_key_fields": ["event_ts", "amount"],
        "quality_filters": ["amount >= 0"],
    }


def test_builtin_manifests_load(taxi):
    assert taxi.resolved_surrogate_key_name == "trip_id"
    assert taxi.event_ts_silver_col == "pickup_datetime"
    assert len(taxi.columns) == 19
    orders = mf.builtin("orders")
    assert orders.resolved_surrogate_key_name == "orders_id"  # default <dataset>_id
    assert orders.spark_ts_pattern == "yyyy-MM-dd'T'HH:mm:ss"  # '' collapsed


def test_schemas(taxi):
    s = taxi.silver_schema()
    assert s.fields[0].name == "trip_id" and s.fields[-1].name == "pickup_date"
    assert isinstance(s["fare_amount"].dataType, T.DecimalType)
    assert isinstance(taxi.bronze_schema()["tpep_pickup_datetime"].dataType, T.TimestampNTZType)


@pytest.mark.parametrize("mutate,needle", [
    (lambda d: d.update(manifest_version=2), "manifest_version"),
    (lambda d: d.update(bronze_table="raw_orders"), "<schema>.<table>"),
    (lambda d: d.update(quality_filters=[]), "at least one"),
    (lambda d: d.update(quality_filters=["a > 0; drop"]), "';'"),
    (lambda d: d.update(partition_date_expr="x; y"), "';'"),
    (lambda d: d["columns"].append(dict(d["columns"][1])), "duplicate"),
    (lambda d: d["columns"][0].update(is_event_ts=False), "exactly one"),
    (lambda d: d.update(event_ts_col="amount"), "is_event_ts is set on"),
    (lambda d: d.update(dedup_key=["nope"]), "dedup_key"),
    (lambda d: d.update(surrogate_key_fields=["nope"]), "surrogate_key_fields"),
    (lambda d: d.update(key_field="nope"), "key_field"),
    (lambda d: d.update(watermark_interval_seconds=0), ">= 1"),
    (lambda d: d.update(name="bad-name"), "identifier"),
    (lambda d: d["columns"][1].update(silver_type="WIDGET"), "unsupported type"),
])
def test_validation_errors(mutate, needle):
    d = _base()
    mutate(d)
    with pytest.raises(mf.ManifestError, match=needle.replace("(", r"\(").replace(")", r"\)")):
        mf.from_dict(d)


def test_type_names():
    assert mf.spark_type("DECIMAL(10, 2)") == T.DecimalType(10, 2)
    assert mf.spark_type("numeric(5)") == T.DecimalType(5, 0)
    assert mf.spark_type("TIMESTAMP(3)") == T.TimestampNTZType()
