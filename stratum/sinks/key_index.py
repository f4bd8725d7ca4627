"""Key index of a partitioned table: which partitions hold a key (UP1, ST5).

A table of the key columns and the partition value, in folders by a hash of the key, beside
the data (``<path>.keys``). An upsert whose keys may change their partition asks it instead
of the data: it reads the folders of the batch's keys only, and narrow rows there.

The index always names at least the partitions that hold a key, also after a failure at
any point: new places are added before the data changes (``announce``), and places that
keys have left are taken out when it has changed (``settle``). A place too many costs the
rewrite of one partition more; a place too few would leave an old row behind. A missing
index is built from one scan of the table's key columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sinks.tables import _exists, in_partitions, partition_values, remove, staging_path

#: Folders of the index. The number is part of the index's path, so another one starts another index.
BUCKETS = 64


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_col: str, buckets: int = BUCKETS):
        self.spark, self.table, self.keys, self.buckets = spark, path, list(keys), buckets
        self.column = partition_col
        self.path = f"{path.rstrip('/')}.keys-{buckets}"
        self._known = self._batch = self._stage = None

    def _entries(self, rows: DataFrame) -> DataFrame:
        place = F.col(self.column).cast("string").alias("place")  # text, so that NULL and every type keep apart
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int").alias("bucket")
        return rows.select(*self.keys, place, bucket).distinct()

    def _same(self, a: str, b: str) -> Column:
        out = F.col(f"{a}.place").eqNullSafe(F.col(f"{b}.place")) & (F.col(f"{a}.bucket") == F.col(f"{b}.bucket"))
        for k in self.keys:
            out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return out

    def _append(self, entries: DataFrame) -> None:
        entries.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(self.path)

    def _read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The index, or some of its folders (a filter on the folder column, which prunes)."""
        types = {f.name: f.dataType.simpleString() for f in self._source.schema.fields}
        schema = ", ".join([f"`{k}` {types[k]}" for k in self.keys] + ["place string", "bucket int"])
        index = self.spark.read.schema(schema).parquet(self.path)
        return index if buckets is None else index.filter(F.col("bucket").isin(list(buckets)))

    @property
    def _source(self) -> DataFrame:
        return self.spark.read.parquet(self.table)

    def build(self) -> None:
        """From the table as it is; an index that is there is replaced."""
        remove(self.spark, self.path)
        self._append(self._entries(self._source))

    def lookup(self, rows: DataFrame) -> DataFrame:
        """The entries of the keys in ``rows``; of the index only the folders of these keys are read."""
        wanted = self._entries(rows).select(*self.keys, "bucket").distinct()
        buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]  # BUCKETS values at most
        return self._read(buckets).join(wanted, [*self.keys, "bucket"], "left_semi").select(*self.keys, "place", "bucket").distinct()

    def announce(self, batch: DataFrame) -> list:
        """Before the data changes: note where the batch puts its keys. Returns the partition values that hold keys of the batch by now."""
        if not _exists(self.spark, self.path):
            self.build()
        self._stage = staging_path(self.spark, "keys")
        self.lookup(batch).write.parquet(f"{self._stage}/known")
        self._entries(batch).write.parquet(f"{self._stage}/batch")
        self._known, self._batch = (self.spark.read.parquet(f"{self._stage}/{x}") for x in ("known", "batch"))
        self._append(self._batch.alias("b").join(self._known.alias("k"), self._same("b", "k"), "left_anti"))
        held = self._known.select(F.col("place").cast(batch.schema[self.column].dataType).alias(self.column))
        return partition_values(held, self.column)

    def settle(self) -> None:
        """After the data has changed: take out the places that the batch's keys have left, in the folders that have some."""
        stale = self._known.alias("k").join(self._batch.alias("b"), self._same("k", "b"), "left_anti")
        buckets = [r[0] for r in stale.select("bucket").distinct().collect()]
        if buckets:
            kept = self._read(buckets).distinct().alias("i").join(stale.select("k.*").alias("s"), self._same("i", "s"), "left_anti")
            kept.write.parquet(f"{self._stage}/kept")
            staged = self.spark.read.schema(kept.schema).parquet(f"{self._stage}/kept")
            left = {r[0] for r in staged.select("bucket").distinct().collect()}
            (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))
            remove(self.spark, *[f"{self.path}/bucket={b}" for b in buckets if b not in left])
        remove(self.spark, self._stage)

    def places(self) -> DataFrame:
        """All entries: key columns and the partition values that hold them."""
        return self._read().drop("bucket")


def touched_by(index: KeyIndex, target: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``target`` in the partitions that hold keys of ``rows``: a scan of these partitions only."""
    kind = target.schema[index.column].dataType
    values = partition_values(index.lookup(rows).select(F.col("place").cast(kind).alias(index.column)), index.column)
    return target.filter(in_partitions(index.column, values))
