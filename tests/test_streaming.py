from certdata import RAW_SCHEMA, edge_set
from pyspark.sql import functions as F

from stratum.operators.parsing import encode_events, parse_events
from stratum.sinks.publish import write_file_topic
from stratum.sources.events import read_file_topic
from stratum.streaming.bronze import start_bronze_stream, start_dedup_stream


def _publish(spark, taxi, topic, rows):
    write_file_topic(encode_events(spark.createDataFrame(rows, RAW_SCHEMA), taxi), topic)


def test_bronze_stream_matches_batch_and_restarts(spark, taxi, tmp):
    rows, want = edge_set(taxi.quality_filters)
    topic, bronze, ckpt = f"{tmp}/topic", f"{tmp}/bronze", f"{tmp}/ckpt"
    _publish(spark, taxi, topic, rows)
    for q in start_bronze_stream(spark, taxi, topic, bronze, ckpt, available_now=True):
        q.awaitTermination()
    assert spark.read.parquet(bronze).count() == want["bronze"]
    batch = parse_events(read_file_topic(spark, topic), taxi).rows.drop("ingestion_ts")
    assert sorted(map(tuple, batch.collect()), key=str) == sorted(
        map(tuple, spark.read.parquet(bronze).drop("ingestion_ts").collect()), key=str)
    # restart from the checkpoint: nothing is read twice; new messages are appended
    _publish(spark, taxi, topic, rows[:10])
    for q in start_bronze_stream(spark, taxi, topic, bronze, ckpt, available_now=True):
        q.awaitTermination()
    assert spark.read.parquet(bronze).count() == want["bronze"] + 10


def test_dedup_stream_first_per_key(spark, taxi, tmp):
    rows, want = edge_set(taxi.quality_filters)
    topic, out, ckpt = f"{tmp}/topic", f"{tmp}/silver", f"{tmp}/ckpt"
    _publish(spark, taxi, topic, rows)
    start_dedup_stream(spark, taxi, topic, out, ckpt, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == want["silver"]
    # a replay of the same events in a later run adds nothing
    _publish(spark, taxi, topic, rows[:30])
    start_dedup_stream(spark, taxi, topic, out, ckpt, available_now=True).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == want["silver"]
    assert got.select("trip_id").distinct().count() == want["silver"]


def test_latest_wins_stream(spark, taxi, tmp):
    from stratum.streaming.bronze import start_latest_wins_stream

    rows, want = edge_set(taxi.quality_filters)
    topic, out, ckpt = f"{tmp}/topic", f"{tmp}/silver", f"{tmp}/ckpt"
    _publish(spark, taxi, topic, rows)
    start_latest_wins_stream(spark, taxi, topic, out, ckpt, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == want["silver"]
    _publish(spark, taxi, topic, rows[:30])  # replays: replaced in place, not added
    start_latest_wins_stream(spark, taxi, topic, out, ckpt, available_now=True).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == want["silver"] and got.select("trip_id").distinct().count() == want["silver"]


def test_late_events(spark, taxi, tmp):
    """Bronze keeps a late event; the streaming de-dup drops it once the watermark has passed it."""
    import datetime as dt
    import random

    from certdata import valid_row

    base = valid_row(random.Random(1))
    at = lambda minute, fare: {**base, "tpep_pickup_datetime": dt.datetime(2024, 1, 10, 12, minute), "fare_amount": fare,
                               "tpep_dropoff_datetime": dt.datetime(2024, 1, 10, 13, 0)}
    topic, bronze, silver = f"{tmp}/topic", f"{tmp}/bronze", f"{tmp}/silver"
    for rows in ([at(0, 1.0)], [at(30, 2.0)], [at(10, 3.0), at(30, 4.0)]):  # 12:10 is behind the watermark of 12:30 less ten seconds
        _publish(spark, taxi, topic, rows)
        for q in [*start_bronze_stream(spark, taxi, topic, bronze, f"{tmp}/c1", available_now=True),
                  start_dedup_stream(spark, taxi, topic, silver, f"{tmp}/c2", available_now=True)]:
            q.awaitTermination()
    assert sorted(r.fare_amount for r in spark.read.parquet(bronze).collect()) == [1.0, 2.0, 3.0, 4.0]
    assert sorted(float(r.fare_amount) for r in spark.read.parquet(silver).collect()) == [1.0, 2.0, 4.0]


def test_rejects_of_a_stream_are_kept(spark, taxi, tmp):
    bad = spark.createDataFrame([("k", "{broken")], "key string, value string")
    write_file_topic(bad, f"{tmp}/topic")
    for q in start_bronze_stream(spark, taxi, f"{tmp}/topic", f"{tmp}/bronze", f"{tmp}/c", available_now=True):
        q.awaitTermination()
    assert [r.payload for r in spark.read.parquet(f"{tmp}/bronze_dlq").collect()] == ["{broken"]


def test_watermark_is_declared(spark, taxi):
    from stratum.streaming.bronze import with_event_time

    df = with_event_time(spark.createDataFrame([], RAW_SCHEMA), taxi)
    assert "EventTimeWatermark" in df._jdf.queryExecution().logical().toString() and "event_time" in df.columns


def test_catch_up_drains_and_rebuilds(spark, taxi, tmp):
    from stratum.streaming.bronze import catch_up

    rows, want = edge_set(taxi.quality_filters)
    _publish(spark, taxi, f"{tmp}/topic", rows)
    first = catch_up(spark, taxi, f"{tmp}/topic", f"{tmp}/w", f"{tmp}/c")
    ids = sorted(r.trip_id for r in first.collect())
    assert len(ids) == want["silver"]
    _publish(spark, taxi, f"{tmp}/topic", rows[:5])  # replays change nothing
    again = catch_up(spark, taxi, f"{tmp}/topic", f"{tmp}/w", f"{tmp}/c")
    assert sorted(r.trip_id for r in again.collect()) == ids


def test_latest_state_keeps_the_newest_over_batches_and_restarts(spark, tmp):
    """Repeated, older and newer versions in several micro-batches, a restart in between, and state that times out."""
    import datetime as dt
    import random

    from stratum.sinks.tables import upsert_by_key
    from stratum.streaming.latest import latest_rows, rocksdb_state

    rng = random.Random(6)
    base = dt.datetime(2024, 1, 1)
    schema = "k string, version long, at timestamp, v string"
    rows = [(f"k{rng.randint(0, 30)}", rng.randint(0, 50), base + dt.timedelta(minutes=20 * b + rng.randint(0, 30), microseconds=rng.randint(0, 999_999)), f"{b}-{i}") for b in range(5) for i in range(40)]
    passed: list[int] = []

    def merge(batch, _id):
        passed.append(batch.count())
        upsert_by_key(batch.sparkSession, f"{tmp}/out", batch.withColumn("d", F.to_date("at")), "k", "d", moves=True)

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
        newest = latest_rows(source, ["k"], "version", "at", delay_seconds=3600, keep_seconds=24 * 3600)
        with rocksdb_state(spark):
            query = (newest.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", f"{tmp}/ck")
                     .trigger(availableNow=True).start())
        query.awaitTermination()

    for b in range(5):
        spark.createDataFrame(rows[40 * b:40 * b + 40], schema).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        if b in (1, 4):
            run()
    before = len(passed)
    spark.createDataFrame(rows[:80], schema).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    run()  # a replay: nothing is newer, so nothing reaches the sink
    assert sum(passed[before:]) == 0
    want = {}
    for k, version, at, v in rows:
        want[k] = max(want.get(k, (-1,)), (version, v))
    ties = {k for k in want if len({v for kk, version, _, v in rows if kk == k and version == want[k][0]}) > 1}
    got = {r.k: (r.version, r.v) for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert set(got) == set(want) and all(got[k][0] == want[k][0] for k in want)
    assert all(got[k] == want[k] for k in set(want) - ties)
    times = {(k, v): at for k, _, at, v in rows}
    assert all(r.at == times[r.k, r.v] for r in spark.read.parquet(f"{tmp}/out").collect())


def test_latest_state_needs_a_few_calls_for_many_keys(spark):
    """A bucket of keys: newest rows, ties, forgotten keys, and as many calls of the state for a thousand keys as for one."""
    from types import SimpleNamespace as Of

    from stratum.streaming.latest import _Latest

    class Handle:
        def __init__(self):
            self.calls, self.entries, self.timers = 0, [], set()

        def getListState(self, name, schema):
            def put(entries):
                self.calls, self.entries = self.calls + 1, list(entries)

            def get():
                self.calls += 1
                return iter(self.entries)

            def exists():
                self.calls += 1
                return bool(self.entries)
            return Of(put=put, get=get, exists=exists, clear=lambda: put([]))

        def listTimers(self):
            self.calls += 1
            return iter(self.timers)

        def registerTimer(self, at):
            self.calls += 1
            self.timers.add(at)

        def deleteTimer(self, at):
            self.calls += 1
            self.timers.discard(at)

    handle, latest = Handle(), _Latest(keep_ms=800)
    latest.init(handle)

    def feed(now, *rows):
        rows = [Of(key=k, version=v, row=r, event_ms=at) for k, v, r, at in rows]
        return sorted(tuple(r) for r in latest.handleInputRows((0,), iter(rows), Of(getCurrentWatermarkInMs=lambda: now)))

    assert feed(0, *[(f"k{i}", 1, "a", i) for i in range(1000)], ("k0", 3, "a", 5), ("k0", 2, "z", 7)) == sorted(
        [("k0", 3, 5, "a"), *[(f"k{i}", 1, i, "a") for i in range(1, 1000)]])
    assert handle.calls < 10 and handle.timers == {900}
    handle.calls = 0
    assert feed(0, ("k0", 3, "a", 5), ("k1", 0, "x", 5), ("k2", 1, "b", 5)) == [("k2", 1, 5, "b")]  # a replay, an older one, a tie
    assert handle.calls < 10
    assert feed(0, ("null", 1, "n", None), ("null", 1, "m", None)) == [("null", 1, None, "n")]
    # forgotten after 800 ms: k1 (of 1 + 800) counts as new again, k200 (of 200 + 800) does not
    assert feed(850, ("k1", 0, "old", 900), ("k200", 0, "old", 900)) == [("k1", 0, 900, "old")]
    assert len(handle.entries) == 1001 - 51 + 1 and handle.timers == {900}  # k0 of 5 and k2 of 5 are forgotten too
    list(latest.handleExpiredTimer((0,), Of(getCurrentWatermarkInMs=lambda: 1_799), Of(getExpiryTimeInMs=lambda: 900)))
    assert [e[0] for e in handle.entries] == ["null"] and handle.timers == {900}  # which Spark deletes
    assert feed(5_000, ("null", 0, "x", None)) == []
