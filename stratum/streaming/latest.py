"""Latest wins as keyed state (ST5).

Per key the state holds the newest version seen and its row. A row that is not newer is
dropped, so a replay or an older copy that arrives late changes nothing downstream; a
newer one is passed on, and the sink upserts it. A key that has had no newer row for
``keep_seconds`` of event time behind the watermark is forgotten, and an event-time timer
frees its state, so the state holds the recent keys only. After that a row of the key counts
as its first again, and the upsert replaces the old one: the sink stays right, as long as
versions of a key do not arrive out of order by more than ``keep_seconds``.

Keys are grouped into buckets by their hash, and the state of a bucket is a list with an entry
per key. Every call between Spark and Python costs the same for a key as for a thousand,
so there are a few for each bucket and micro-batch, and none for each key. A micro-batch reads and
writes the buckets it touches; more ``buckets`` make these smaller, and their number is fixed
for the life of a checkpoint.

The state is in RocksDB, checkpointed with the query, and survives restarts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stratum.manifest import Manifest

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times as JSON, to the microsecond.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: What goes in and out: the key, its version, the event time in milliseconds, and the row as JSON.
SCHEMA = "key STRING, version BIGINT, event_ms BIGINT, row STRING"
#: Buckets of keys; the recent keys of one bucket are in the memory of a task at once.
BUCKETS = 1024
#: Expired keys of a bucket are removed at most so often in ``keep_seconds``.
TIMER_STEPS = 8


class _Latest(StatefulProcessor):
    """The group is a bucket of keys, whose newest rows are one list: a call for each bucket and batch, not several for each key."""

    def __init__(self, keep_ms: int):
        self.keep_ms, self.step_ms = keep_ms, max(1, keep_ms // TIMER_STEPS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "key STRING, version BIGINT, row STRING, until_ms BIGINT")

    def _held(self, now: int) -> tuple[dict[str, tuple], bool]:
        """key -> (version, row, until_ms) of the keys whose time has not come, and whether there are others."""
        entries = list(self.best.get()) if self.best.exists() else []
        held = {key: (version, row, until) for key, version, row, until in entries if until is None or until > now}
        return held, len(held) < len(entries)

    def _keep(self, held: dict[str, tuple]) -> None:
        if held:
            self.best.put([(key, *entry) for key, entry in held.items()])
        else:
            self.best.clear()

    def _wake(self, held: dict[str, tuple], timers: set[int]) -> None:
        """One timer for the bucket, at the first of its keys' times, rounded up so that a bucket is not rewritten for every key."""
        due = min((until for _, _, until in held.values() if until is not None), default=None)
        due = None if due is None else -(-due // self.step_ms) * self.step_ms
        for timer in timers - {due}:
            self.handle.deleteTimer(timer)
        if due is not None and due not in timers:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held, changed = self._held(now)
        newer: dict[str, int | None] = {}
        for r in rows:
            before = held.get(r.key)
            if before is not None and (r.version, r.row) <= before[:2]:  # equal versions: the same choice in every order of arrival
                continue
            held[r.key] = (r.version, r.row, None if r.event_ms is None else max(r.event_ms, now) + self.keep_ms)
            newer[r.key] = r.event_ms
        if newer or changed:
            self._keep(held)
            self._wake(held, set(self.handle.listTimers()))
        for k, event_ms in newer.items():
            yield Row(key=k, version=held[k][0], event_ms=event_ms, row=held[k][1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, changed = self._held(timerValues.getCurrentWatermarkInMs())
        if changed:
            self._keep(held)
        self._wake(held, set(self.handle.listTimers()) - {expiredTimerInfo.getExpiryTimeInMs()})  # Spark deletes the expired one
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start in the block keep their state in RocksDB; the session's setting is as before afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def latest_rows(rows: DataFrame, keys: Sequence[str], version: str, event_time: str, delay_seconds: int, keep_seconds: int,
                buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream that are the newest version of their key when they arrive (update mode). ``version`` names an
    integer or time column; rows without one are older than all others."""
    timed = dict(rows.dtypes)[version].startswith("timestamp")
    number = F.unix_micros(F.col(version).cast("timestamp")) if timed else F.col(version).cast("long")
    packed = rows.withColumn("event_time", F.col(event_time).cast("timestamp")).withWatermark("event_time", f"{delay_seconds} seconds").select(
        F.to_json(F.struct(*keys), {**JSON, "ignoreNullFields": "false"}).alias("key"), F.coalesce(number, F.lit(-(1 << 63))).alias("version"),
        F.unix_millis("event_time").alias("event_ms"), F.to_json(F.struct(*rows.columns), JSON).alias("row"), "event_time")
    dealt = packed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    newest = dealt.groupBy("bucket").transformWithState(_Latest(1000 * keep_seconds), SCHEMA, "Update", "EventTime")
    return newest.select(F.from_json("row", rows.schema, JSON).alias("row")).select("row.*")


def start_latest_state_stream(spark: SparkSession, manifest: Manifest, topic: DataFrame | str, silver_path: str, checkpoint: str,
                              keep_seconds: int = 7 * 24 * 3600, available_now: bool = False, interval: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Silver by keyed state: only rows that are newest are upserted. Rows that fail a quality filter never reach the state."""
    from stratum.operators.parsing import parse_events
    from stratum.operators.silver import quality_filter, silver
    from stratum.plans.pipeline import date_follows_key
    from stratum.sinks.tables import upsert_by_key
    from stratum.sources.events import stream_file_topic
    from stratum.streaming.bronze import _trigger

    moves = not date_follows_key(manifest, manifest.surrogate_key_fields)
    if isinstance(topic, str):
        topic = stream_file_topic(spark, topic)
    rows = quality_filter(parse_events(topic, manifest).rows, manifest.quality_filters)
    newest = latest_rows(rows, manifest.dedup_key, "ingestion_ts", manifest.event_ts_col, manifest.watermark_interval_seconds, keep_seconds,
                         buckets)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        upsert_by_key(batch.sparkSession, silver_path, silver(batch, manifest), manifest.resolved_surrogate_key_name,
                      manifest.partition_date_col, moves=moves)

    writer = (newest.writeStream.outputMode("update").foreachBatch(merge)
              .option("checkpointLocation", f"{checkpoint.rstrip('/')}/silver_state"))
    with rocksdb_state(spark):
        return _trigger(writer, available_now, interval).start()
