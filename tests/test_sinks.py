import datetime as dt
import os

from certdata import RAW_SCHEMA, edge_set
from pyspark.sql import functions as F

from stratum.operators.parsing import encode_events, parse_events
from stratum.operators.silver import silver
from stratum.sinks import compaction, tables


def _silver_df(spark, taxi, ts="2024-02-01 00:00:00"):
    rows, _ = edge_set(taxi.quality_filters)
    b = parse_events(encode_events(spark.createDataFrame(rows, RAW_SCHEMA), taxi), taxi, ingestion_ts=ts).rows
    return silver(b, taxi)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_silver_write_is_idempotent(spark, taxi, tmp):
    s = _silver_df(spark, taxi)
    tables.write_silver(s, taxi, tmp)
    path = tables.layer_path(tmp, taxi.silver_table)
    first = _rows(spark.read.parquet(path))
    tables.write_silver(s, taxi, tmp)  # re-run: same partitions replaced, nothing duplicated
    assert _rows(spark.read.parquet(path)) == first and len(first) == 50


def test_upsert_replaces_keys_and_keeps_others(spark, taxi, tmp):
    s = _silver_df(spark, taxi)
    path = f"{tmp}/silver"
    tables.write_partitioned(s, path, "pickup_date")
    some = s.orderBy("trip_id").limit(5)
    changed = some.withColumn("store_and_fwd_flag", F.lit("U"))
    tables.upsert_by_key(spark, path, changed, "trip_id", "pickup_date")
    out = spark.read.parquet(path)
    assert out.count() == 50
    assert out.filter(F.col("store_and_fwd_flag") == "U").count() == 5
    assert out.select("trip_id").distinct().count() == 50


def test_upsert_rejects_schema_change(spark, taxi, tmp):
    s = _silver_df(spark, taxi)
    path = f"{tmp}/silver"
    tables.write_partitioned(s, path, "pickup_date")
    import pytest

    with pytest.raises(ValueError, match="schema change"):
        tables.upsert_by_key(spark, path, s.withColumn("extra_col", F.lit(1)), "trip_id", "pickup_date")


def test_incremental_rows_high_water(spark):
    target = spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "ts timestamp_ntz")
    incoming = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),),
                                      (dt.datetime(2024, 1, 3),)], "ts timestamp_ntz")
    assert tables.incremental_rows(incoming, target, "ts").count() == 1  # equal is skipped
    assert tables.incremental_rows(incoming, target, "ts", lookback="1 day").count() == 2
    assert tables.incremental_rows(incoming, None, "ts").count() == 3


def test_compaction_same_rows_fewer_files(spark, taxi, tmp):
    s = _silver_df(spark, taxi)
    path = f"{tmp}/silver"
    for i in range(4):  # many small appends
        s.filter(F.abs(F.hash("trip_id")) % 4 == i).write.mode("append").partitionBy("pickup_date").parquet(path)
    before = _rows(spark.read.parquet(path))
    files_before = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).count()
    assert compaction.compact(spark, path, "pickup_date") > 0
    files_after = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).count()
    assert _rows(spark.read.parquet(path)) == before
    assert files_after < files_before


def test_upsert_prunes_evaluates_once_and_cleans_up(spark, taxi, tmp):
    import glob

    s = _silver_df(spark, taxi)
    path = f"{tmp}/silver"
    tables.write_partitioned(s, path, "pickup_date")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    first_day = min(r.pickup_date for r in s.select("pickup_date").collect())
    batch = spark.createDataFrame(s.filter(F.col("pickup_date") == F.lit(first_day)).collect(), s.schema)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    tables.upsert_by_key(spark, path, batch.mapInArrow(count, batch.schema), "trip_id", "pickup_date")
    assert seen.value == batch.count()  # one evaluation
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    assert {f for f in before if f not in after} == {f for f in before if f"pickup_date={first_day}" in f}  # other dates untouched
    assert _rows(spark.read.parquet(path)) == _rows(s)
    root = spark.conf.get("spark.checkpoint.dir")
    assert glob.glob(f"{root}/staging/*") == []


def test_upsert_of_a_key_that_moves_between_dates(spark, tmp):
    path = f"{tmp}/t"
    old = spark.createDataFrame([("a", 1, dt.date(2024, 1, 1)), ("b", 1, dt.date(2024, 1, 2))], "k string, v int, d date")
    tables.write_partitioned(old, path, "d")
    new = spark.createDataFrame([("a", 2, dt.date(2024, 1, 2))], "k string, v int, d date")
    tables.upsert_by_key(spark, path, new, "k", "d", moves=True)
    got = sorted((r.k, r.v, r.d) for r in spark.read.parquet(path).collect())
    assert got == [("a", 2, dt.date(2024, 1, 2)), ("b", 1, dt.date(2024, 1, 2))]


def _cells(spark, path, schema="k string, v int, d date"):
    return sorted(((r.k, r.v, r.d) for r in spark.read.schema(schema).parquet(path).collect()), key=str)


def test_upsert_keeps_null_partitions(spark, tmp):
    """NULL dates in the batch, in the target, in both, and alone."""
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    make = lambda rows: spark.createDataFrame(rows, "k string, v int, d date")
    for moves in (False, True):
        path = f"{tmp}/null-{moves}"
        tables.upsert_by_key(spark, path, make([("n", 1, None)]), "k", "d", moves=moves)  # NULL is the only partition
        tables.upsert_by_key(spark, path, make([("n", 2, None), ("m", 2, None)]), "k", "d", moves=moves)
        assert _cells(spark, path) == [("m", 2, None), ("n", 2, None)]
        tables.upsert_by_key(spark, path, make([("a", 3, d1), ("b", 3, d2)]), "k", "d", moves=moves)
        tables.upsert_by_key(spark, path, make([("a", 4, d1), ("n", 4, None), ("z", 4, None)]), "k", "d", moves=moves)
        assert _cells(spark, path) == [("a", 4, d1), ("b", 3, d2), ("m", 2, None), ("n", 4, None), ("z", 4, None)]
    tables.upsert_by_key(spark, path, make([("m", 5, d2), ("n", 5, d1), ("z", 5, d1), ("b", 5, None)]), "k", "d", moves=True)
    assert _cells(spark, path) == [("a", 4, d1), ("b", 5, None), ("m", 5, d2), ("n", 5, d1), ("z", 5, d1)]
    tables.upsert_by_key(spark, path, make([("b", 6, d1)]), "k", "d", moves=True)
    assert not os.path.exists(f"{path}/d=__HIVE_DEFAULT_PARTITION__") and len(_cells(spark, path)) == 5


def test_key_index_prunes_and_follows_moves(spark, tmp):
    from stratum.sinks.key_index import KeyIndex, touched_by

    path = f"{tmp}/moving"
    rows = [(f"k{i}", 0, dt.date(2024, 1, 1 + i % 9)) for i in range(200)]
    make = lambda rows: spark.createDataFrame(rows, "k string, v int, d date")
    tables.write_partitioned(make(rows), path, "d")  # no index yet: the first moving upsert builds it
    want = {k: (v, d) for k, v, d in rows}
    rng = __import__("random").Random(3)
    for step in range(1, 4):
        batch = [(f"k{i}", step, dt.date(2024, 1, rng.randint(1, 12))) for i in rng.sample(range(260), 30)]
        tables.upsert_by_key(spark, path, make(batch), "k", "d", moves=True)
        want |= {k: (v, d) for k, v, d in batch}
        assert {k: (v, d) for k, v, d in _cells(spark, path)} == want
        index = KeyIndex(spark, path, ["k"], "d")
        assert sorted((r.k, r.place) for r in index.places().collect()) == sorted((k, str(d)) for k, (_, d) in want.items())
    found = touched_by(index, spark.read.parquet(path), make([("k3", 9, None)]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and str(want["k3"][1]) in plan
    asked = index.lookup(make([("k3", 9, None)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in asked.replace("isnotnull(bucket", "bucket") or "bucket" in asked.split("PartitionFilters: [")[1][:80]
    tables.upsert_by_key(spark, path, make([("k999", 1, dt.date(2024, 1, 1))]), "k", "d")  # a plain upsert keeps the index up
    assert ("k999", "2024-01-01") in {(r.k, r.place) for r in index.places().collect()}
    tables.full_refresh(make(rows), path, "d")
    assert not os.path.exists(index.path)


def test_existing_table_that_cannot_be_read_is_not_new(spark, tmp, monkeypatch):
    import pytest

    os.makedirs(f"{tmp}/torn")
    with open(f"{tmp}/torn/part-0.parquet", "wb") as f:
        f.write(b"no parquet")
    with pytest.raises(Exception):
        tables._exists(spark, f"{tmp}/torn")
    assert not tables._exists(spark, f"{tmp}/none")
    os.makedirs(f"{tmp}/empty")
    assert not tables._exists(spark, f"{tmp}/empty")


def test_full_rebuild_drops_stale_dates(spark, taxi, tmp):
    s = _silver_df(spark, taxi)
    tables.write_silver(s, taxi, tmp)
    part = s.filter(F.dayofmonth("pickup_date") <= 10)
    tables.write_silver(part, taxi, tmp, full=True)
    assert _rows(spark.read.parquet(tables.layer_path(tmp, taxi.silver_table))) == _rows(part)


def test_incremental_rows_prune_by_date(spark, tmp):
    rows = [(dt.datetime(2024, 1, d, 5), dt.date(2024, 1, d)) for d in range(1, 8)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, d date")
    tables.write_partitioned(df, f"{tmp}/in", "d")
    out = tables.incremental_rows(spark.read.parquet(f"{tmp}/in"), df.filter("d <= DATE '2024-01-05'"), "ts", "12 hours", "d")
    assert sorted(str(r.d) for r in out.collect()) == ["2024-01-05", "2024-01-06", "2024-01-07"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_publish_keeps_every_row_and_key(spark, taxi, tmp):
    import json
    from pathlib import Path

    from stratum import manifest as mf
    from stratum.sinks.publish import publish
    from stratum.sources.events import read_file_topic

    rows, _ = edge_set(taxi.quality_filters)
    rows += [{**rows[0], "tpep_pickup_datetime": dt.datetime(2024, 1, 3, 4, 5, 6, 250000), "PULocationID": None}]
    schema = json.loads(Path(mf.DATASETS_DIR / "taxi.schema.json").read_text())
    publish(spark.createDataFrame(rows, RAW_SCHEMA), taxi, f"{tmp}/topic", json_schema=schema)
    topic, dead = read_file_topic(spark, f"{tmp}/topic").collect(), read_file_topic(spark, f"{tmp}/topic.dlq").collect()
    assert len(topic) + len(dead) == len(rows) and len(dead) == 2  # NULL pickup, NULL dropoff
    assert sorted(m.key for m in topic) == sorted("" if json.loads(m.value)["PULocationID"] is None else str(json.loads(m.value)["PULocationID"]) for m in topic)
    parsed = parse_events(read_file_topic(spark, f"{tmp}/topic"), taxi).rows
    assert sorted(str(r.tpep_pickup_datetime) for r in parsed.collect()) == sorted(
        str(r["tpep_pickup_datetime"]) for r in rows if r["tpep_pickup_datetime"] and r["tpep_dropoff_datetime"])
    assert len(os.listdir(f"{tmp}/topic")) > 1


def test_namespaces(spark, tmp):
    tables.ensure_namespaces(spark, tmp, ("bronze_ns", "silver_ns"))
    assert {"bronze_ns", "silver_ns"} <= {d.name for d in spark.catalog.listDatabases()}
    for d in ("bronze_ns", "silver_ns"):
        spark.sql(f"DROP DATABASE {d}")
