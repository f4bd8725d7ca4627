"""Publishing events (SNK3): rows → messages on a topic, rejected ones on its dead-letter topic.

One pass: the schema gate gives every message a route, and one write puts the routes
into their folders. Messages with the same key share a topic partition (key affinity) and stand
in it in source order, unless the key is empty or NULL: those are spread by a hash of
the message, as is everything on the dead-letter topic.

A key with more messages than half an even share of a partition is hot: its messages are
dealt over all partitions, and each carries its number in source order (``seq``), by which a
reader restores the order of the key. Hot keys are measured first, from the key column alone,
by counters of bounded number in each task (Misra-Gries), so no task and no message
of the measurement grows with the number of keys.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.manifest import Manifest
from stratum.operators.parsing import dlq_envelope, encode_events, schema_gate

COUNTERS = 10  # of a task, per partition of the topic
HOT_SHARE = 0.5  # of an even share of a partition
VALID, REJECTED = "valid", "rejected"


def route_of(key: str = "key", value: str = "value") -> Column:
    """What decides a message's topic partition: its key, or the message if it has none.
    Deterministic, so a retried task routes every row as before."""
    return F.when(F.col(key).isNull() | (F.col(key) == ""), F.xxhash64(value)).otherwise(F.xxhash64(key))


def heavy_hitters(df: DataFrame, key: str, counters: int) -> DataFrame:
    """(key, at_least): the keys that may have more than 1 / ``counters`` of the rows, with a lower bound of
    their count that is too small by at most that share. NULL and empty keys are left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                if entry["values"]:
                    held[entry["values"]] += entry["counts"]
            if len(held) > counters:
                least = sorted(held.values(), reverse=True)[counters]
                held = Counter({k: n - least for k, n in held.items() if n > least})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["key", "at_least"])

    found = df.select(F.col(key).cast("string").alias("key")).mapInArrow(count, "key string, at_least long")
    return found.groupBy("key").agg(F.sum("at_least").alias("at_least"))


def hot_keys(messages: DataFrame, partitions: int) -> list[str]:
    """The keys with more than HOT_SHARE of an even share of the messages; there are at most partitions / HOT_SHARE."""
    total = messages.count()
    found = heavy_hitters(messages, "key", COUNTERS * partitions).where(F.col("at_least") > HOT_SHARE * total / partitions)
    return sorted(r.key for r in found.collect())


def dealt(messages: DataFrame, partitions: int) -> DataFrame:
    """``(key, value, seq)`` in ``partitions`` partitions, each in source order; ``seq`` is kept for hot keys only."""
    hot = hot_keys(messages, partitions) if partitions > 1 else []
    is_hot = F.coalesce(F.col("key").isin(hot), F.lit(False)) if hot else F.lit(False)
    numbered = messages.select("key", "value", F.monotonically_increasing_id().alias("seq")).withColumn("hot", is_hot)
    to = F.pmod(F.when(F.col("hot"), F.xxhash64("seq")).otherwise(route_of()), F.lit(partitions)).cast("int")
    return (numbered.repartitionById(partitions, to).sortWithinPartitions("seq")
            .select("key", "value", F.when(F.col("hot"), F.col("seq")).alias("seq")))


def write_file_topic(messages: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append ``(key, value)`` messages to a file topic.

    ``partitions`` is the topic's partition count; by default the session's shuffle partitions,
    which a cluster sizes to its data.
    """
    n = partitions or max(1, int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt(messages, n).write.mode("append").json(path)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish to Kafka (needs the Kafka connector on the classpath)."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def dlq_path_of(topic_path: str) -> str:
    return f"{topic_path.rstrip('/')}.dlq"


def publish(rows: DataFrame, manifest: Manifest, topic_path: str, dlq_path: str | None = None,
            json_schema: dict | None = None, partitions: int | None = None, at=None) -> None:
    """Encode rows as events and publish them; with a JSON Schema, rejected messages go to the
    dead-letter topic (by default ``<topic>.dlq``) as envelopes instead.

    The rows are read and encoded once: valid and rejected messages are staged side by side, split by
    route, and each topic is appended from its own folder of the stage.
    """
    messages = encode_events(rows, manifest)
    if json_schema is None:
        write_file_topic(messages, topic_path, partitions)
        return
    from stratum.sinks.tables import remove, staging_path

    spark = rows.sparkSession
    stage = staging_path(spark, "publish")
    gated = schema_gate(messages, json_schema).withColumn(
        "route", F.when(F.col("error").isNull(), VALID).otherwise(REJECTED))
    gated.write.partitionBy("route").parquet(stage)
    staged = spark.read.schema("key STRING, value STRING, error STRING, route STRING").parquet(stage)
    write_file_topic(staged.filter(F.col("route") == VALID), topic_path, partitions)
    rejected = staged.filter(F.col("route") == REJECTED)
    envelopes = dlq_envelope(rejected, at=at).select(F.lit(None).cast("string").alias("key"), "value")
    write_file_topic(envelopes, dlq_path or dlq_path_of(topic_path), partitions)
    remove(spark, stage)
