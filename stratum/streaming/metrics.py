"""Run metrics of streams (RC8): a metrics row per micro-batch, from the queries' progress.

A ``StreamingQueryListener`` receives the progress of every query of the session; of those
that are followed it keeps what the parse observed (messages, rejected). ``write`` adds the rows
to the same table as batch runs do, so that ``metrics_trust`` and completeness checks can
use them. A batch that is repeated after a failure has the run id it had before, and
``write`` adds no row twice.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from stratum.operators.reconcile import METRICS_SCHEMA

WAIT_SECONDS = 60  # for the last progress of a query that has ended


class StreamMetrics(StreamingQueryListener):
    def __init__(self, dataset: str, topic: str, data_path: str, broker: str = ""):
        self.dataset, self.topic, self.data_path, self.broker = dataset, topic, data_path, broker
        self._lock, self._rows, self._ended = threading.Lock(), {}, {}

    # -- what Spark calls
    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = next((m.asDict() for m in p.observedMetrics.values() if {"messages", "rejected"} <= set(m.asDict())), None)
        if not seen or not seen["messages"]:
            return
        valid, took = int(seen["messages"]) - int(seen["rejected"]), p.durationMs.get("triggerExecution", 0) / 1000
        row = (valid, int(seen["rejected"]), round(took, 3), round(valid / took, 1) if took > 0 else 0.0, "stream", self.broker, self.dataset,
               self.topic, self.data_path, p.timestamp, f"{p.id}-{p.batchId:09d}", False)
        with self._lock:
            self._rows.setdefault(str(p.id), {})[p.batchId] = row

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.id)).set()

    # -- what a job calls
    def _end_of(self, query_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(query_id, threading.Event())

    def write(self, spark: SparkSession, query: StreamingQuery, path: str) -> int:
        """Append the rows of ``query`` that the table does not have; returns their number. Of a query
        that has ended the last progress is waited for. May be called as often as one likes."""
        from stratum.sinks.tables import _exists

        if not query.isActive and not self._end_of(str(query.id)).wait(WAIT_SECONDS):
            raise TimeoutError("the progress of the ended query has not arrived")
        with self._lock:
            rows = list(self._rows.pop(str(query.id), {}).values())
        new: DataFrame = spark.createDataFrame(rows, METRICS_SCHEMA)
        if rows and _exists(spark, path):
            known = spark.read.schema(METRICS_SCHEMA).parquet(path).where(F.col("run_id").isin([r[10] for r in rows])).select("run_id").distinct()
            new = spark.createDataFrame(new.join(known, "run_id", "left_anti").select(*METRICS_SCHEMA.names).collect(), METRICS_SCHEMA)
        n = new.count()
        if n:
            new.coalesce(1).write.mode("append").parquet(path)
        return n


@contextmanager
def stream_metrics(spark: SparkSession, dataset: str, topic: str, data_path: str, broker: str = "") -> Iterator[StreamMetrics]:
    """A listener that is registered while the block runs."""
    listener = StreamMetrics(dataset, topic, data_path, broker)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
