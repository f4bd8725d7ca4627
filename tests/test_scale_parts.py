"""Prefix sums, mergeable key state, batch ledger, late ledger, stream metrics, hot keys, counts from footers."""

import datetime as dt
import json
import random

from certdata import RAW_SCHEMA, edge_set
from pyspark.sql import functions as F

from stratum.operators import key_state, prefix, reconcile
from stratum.operators.parsing import encode_events
from stratum.operators.silver import silver
from stratum.plans import pipeline
from stratum.sinks import publish
from stratum.sinks.ledger import ledger_path, update_ledger
from stratum.sinks.publish import write_file_topic
from stratum.sources.events import read_numbered_topic
from stratum.streaming import late
from stratum.streaming.metrics import stream_metrics


def _rows(df):
    return sorted(map(str, df.collect()))


# ------------------------------------------------------------ prefix sums
def test_running_totals_against_plain(spark, tmp):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 1, 1, 2, 5]), i, rng.choice([None, rng.randint(-9, 9)])) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, v long").repartition(6)
    out = prefix.running_totals(df, ["a", "b"], {"total": "v", "n": F.lit(1).cast("long")}, f"{tmp}/stage", ranges=7)
    want, total = set(), None
    for n, (a, b, v) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), 1):
        total = total if v is None else (total or 0) + v
        want.add((a, b, v, total, n))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the row per range
    assert set(map(tuple, out.collect())) == want
    assert prefix.running_numbers(df.limit(0), ["a"], f"{tmp}/none").count() == 0


# -------------------------------------------------------------- key state
def test_key_states_merge_to_the_one_shot_count(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(100_000, 100_400), 7, -3]), rng.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k long, v int")
    filters = ["v > 3"]
    one = reconcile.row_accounting(df, filters, ["k"])
    parts = [key_state.batch_state(df.filter(F.col("v") % 3 == i), f"b{i}", filters, F.col("k")) for i in range(3)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert _rows(key_state.accounting(states)) == _rows(one)
    assert _rows(key_state.accounting(states.unionByName(parts[1]))) == _rows(one)  # a batch written twice
    assert key_state.accounting(states.limit(0)).first().bronze_rows == 0


# ----------------------------------------------------------- batch ledger
def test_silver_input_reads_the_files_of_touched_dates(spark, taxi, tmp):
    rows, _ = edge_set(taxi.quality_filters)
    good = [r for r in rows if r["tpep_pickup_datetime"]]
    days = sorted({r["tpep_pickup_datetime"].date() for r in good})
    one, two = [r for r in good if r["tpep_pickup_datetime"].date() <= days[4]], [r for r in good if r["tpep_pickup_datetime"].date() >= days[4]]
    undated = [{**good[0], "tpep_pickup_datetime": None}]
    stamp = [dt.datetime(2024, 2, i) for i in (1, 2, 3)]
    for at, part in zip(stamp, (one + undated, two, undated)):
        pipeline.run_bronze(spark, taxi, encode_events(spark.createDataFrame(part, RAW_SCHEMA), taxi), tmp, ingestion_ts=at)
    bronze = pipeline.paths_of(taxi, tmp)["bronze"]
    everything = spark.read.parquet(bronze)
    keys = lambda df: _rows(df.drop("ingestion_ts"))
    second = pipeline.silver_input(spark, taxi, bronze, stamp[1])
    assert keys(second) == keys(everything.filter(F.to_date("tpep_pickup_datetime") >= F.lit(days[4])))
    third = pipeline.silver_input(spark, taxi, bronze, stamp[2])  # only rows without a date
    assert keys(third) == keys(everything.filter("tpep_pickup_datetime IS NULL")) and third.count() == 2
    assert len(third.inputFiles()) < len(everything.inputFiles())
    assert pipeline.silver_input(spark, taxi, bronze, dt.datetime(2020, 1, 1)).count() == 0
    # files of another writer are found, and files that are gone are forgotten
    everything.filter("tpep_pickup_datetime IS NULL").withColumn("ingestion_ts", F.lit(stamp[0])).coalesce(1).write.mode("append").parquet(bronze)
    assert pipeline.silver_input(spark, taxi, bronze, stamp[2]).count() == 4
    before = spark.read.parquet(ledger_path(bronze)).count()
    update_ledger(spark, taxi, bronze)
    assert spark.read.parquet(ledger_path(bronze)).count() == before
    spark.read.parquet(bronze).coalesce(1).write.mode("overwrite").parquet(f"{tmp}/whole")
    spark.read.parquet(f"{tmp}/whole").write.mode("overwrite").parquet(bronze)
    assert pipeline.silver_input(spark, taxi, bronze, stamp[2]).count() == 4


def test_incremental_silver_equals_full_rebuild_with_null_dates(spark, taxi, tmp):
    from dataclasses import replace

    manifest = replace(taxi, quality_filters=[f for f in taxi.quality_filters if "pickup" not in f])  # rows without a date pass
    rows, _ = edge_set(taxi.quality_filters)
    for at, part in ((1, rows[:30]), (2, rows[20:])):
        run = pipeline.run_bronze(spark, manifest, encode_events(spark.createDataFrame(part, RAW_SCHEMA), manifest), tmp, ingestion_ts=dt.datetime(2024, 2, at))
        pipeline.run_silver(spark, manifest, tmp, run)
    paths = pipeline.paths_of(manifest, tmp)
    got = spark.read.parquet(paths["silver"])
    want = silver(spark.read.parquet(paths["bronze"]), manifest)
    assert _rows(got.select(*sorted(got.columns))) == _rows(want.select(*sorted(got.columns)))
    assert got.filter("pickup_date IS NULL").count() > 0


# ------------------------------------------------------------ late events
def test_late_ledger_is_what_the_stream_drops(spark, tmp):
    rng = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, b, base + dt.timedelta(seconds=60 * b + rng.uniform(-120, 60))) for b in range(6) for i in range(b * 40, b * 40 + 40)]
    rows += [(900, 2, None), (901, 3, base - dt.timedelta(days=1))]
    df = spark.createDataFrame(rows, "id int, batch int, at timestamp")
    for b in range(6):
        df.filter(F.col("batch") == b).coalesce(1).write.mode("append").json(f"{tmp}/in/{b}")
    ledger = late.late_ledger(df, "batch", "at", 10)
    assert ledger.count() == len(rows)
    lateness = {r.id for r in ledger.filter("late").collect()}
    source = spark.readStream.schema("id int, batch int, at timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(f"{tmp}/in")
    stream = source.withWatermark("at", "10 seconds").dropDuplicatesWithinWatermark(["id"])
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start(f"{tmp}/out"))
    query.awaitTermination()
    kept = {r.id for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert lateness and kept == {r[0] for r in rows} - lateness
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == len(lateness)


# --------------------------------------------------------- stream metrics
def test_stream_metrics_rows_per_batch(spark, taxi, tmp):
    from stratum.streaming.bronze import start_bronze_stream

    rows, want = edge_set(taxi.quality_filters)
    topic, path = f"{tmp}/topic", f"{tmp}/metrics"
    write_file_topic(encode_events(spark.createDataFrame(rows, RAW_SCHEMA), taxi), topic, 2)
    spark.createDataFrame([("k", "no json")], "key string, value string").coalesce(1).write.mode("append").json(topic)
    for _ in range(2):  # the second run finds nothing new
        with stream_metrics(spark, taxi.name, taxi.topic, topic) as metrics:
            first, second = start_bronze_stream(spark, taxi, topic, f"{tmp}/bronze", f"{tmp}/ck", available_now=True)
            first.awaitTermination(), second.awaitTermination()
            metrics.write(spark, first, path)
            assert metrics.write(spark, first, path) == 0
    got = spark.read.parquet(path).collect()
    assert len(got) == 1 and (got[0].events, got[0].invalid, got[0].mode) == (len(rows), 1, "stream")
    trust = reconcile.metrics_trust(spark.read.parquet(path), taxi.name, taxi.topic, topic).first()
    assert trust.passed, trust.message


# --------------------------------------------------------------- hot keys
def test_hot_key_is_spread_and_its_order_restored(spark, tmp):
    rows = [("hot" if i % 2 else f"k{i % 97}", json.dumps({"n": i})) for i in range(8000)] + [("", "{}")] * 100 + [(None, "{}")] * 100
    df = spark.createDataFrame(rows, "key string, value string").coalesce(1)
    assert publish.hot_keys(df, 8) == ["hot"] and publish.hot_keys(df.filter("key <> 'hot'"), 8) == []
    sizes = sorted(r["count"] for r in publish.dealt(df, 8).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    write_file_topic(df, f"{tmp}/t", 8)
    got = read_numbered_topic(spark, f"{tmp}/t")
    assert sorted(map(str, got.select("key", "value").collect())) == sorted(map(str, df.collect()))
    restored = [json.loads(r.value)["n"] for r in got.filter("key = 'hot'").orderBy("seq").collect()]
    assert restored == sorted(restored) and len(restored) == 4000
    assert got.filter("key <> 'hot' AND seq IS NOT NULL").count() == 0
    assert publish.hot_keys(df.limit(0), 8) == []


# ----------------------------------------------------- counts from footers
def test_layer_counts_read_footers_only(spark, tmp):
    spark.range(1000).withColumn("d", F.col("id") % 3).write.partitionBy("d").parquet(f"{tmp}/t")
    spark.range(0).write.parquet(f"{tmp}/empty")
    counts = reconcile.layer_counts(spark, {"t": f"{tmp}/t", "none": f"{tmp}/none", "frame": spark.range(5), "empty": f"{tmp}/empty"})
    got = {r.layer: (r.rows, r.ok) for r in counts.collect()}
    assert got == {"t": (1000, True), "none": (-1, False), "frame": (5, True), "empty": (0, True)}
    plan = reconcile.layer_counts(spark, {"t": f"{tmp}/t"})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
