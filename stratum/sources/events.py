"""Event topics (SRC3–SRC5): bounded and unbounded reads of JSON messages.

Two transports share one shape, ``(key STRING, value STRING)``:

* a *file topic*: a directory of JSON lines, one ``{"key": .., "value": ..}``
  per message, the value as text (so that a malformed one stays as it is) —
  what the tests and local runs use;
* Kafka: ``format("kafka")`` with ``earliest`` → ``latest`` offsets for a
  bounded read, or from ``earliest`` without an end for a stream (progress
  lives in the streaming checkpoint, not in a consumer group). The Kafka
  connector jar is not part of this environment, so that path is written
  but not exercised by the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MESSAGE = "key STRING, value STRING"


def read_file_topic(spark: SparkSession, path: str) -> DataFrame:
    """Bounded read of a file topic: every message present now, with its key."""
    return spark.read.schema(MESSAGE).json(path)


def read_numbered_topic(spark: SparkSession, path: str) -> DataFrame:
    """The same with ``seq``, the place in source order of the messages of hot keys, whose partitions
    are several; within one publication, ``orderBy("key", "seq")`` restores the order of such a key."""
    return spark.read.schema(f"{MESSAGE}, seq BIGINT").json(path)


def stream_file_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded read of a file topic; new files are picked up as they land."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def _kafka(reader, servers: str, topic: str, bounded: bool):
    r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if bounded:
        r = r.option("endingOffsets", "latest")
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Bounded Kafka read: earliest → latest offsets at start, then stop."""
    return _kafka(spark.read, servers, topic, bounded=True)


def stream_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Unbounded Kafka read from the earliest offset (or the checkpoint)."""
    return _kafka(spark.readStream, servers, topic, bounded=False)
