"""Helpers shared by the corpus operators: shared-folder tables, Arrow batches, components."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once inside a Python task.
SLICE_BYTES = 8 << 20
#: Bytes of one Arrow batch between Spark and a Python worker, unless the session sets its own.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it. On a
    cluster the package is installed, or shipped with ``--py-files``; the entry does no harm there.
    Arrow batches get a bound that suits whole texts, if the session has none of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return root.rstrip("/")


class Scratch:
    """Tables of one operator run, written below the shared folder.

    A written table cuts the lineage: a lost executor costs a re-read, not a re-run.
    ``drop`` frees a table that nothing reads any more; what the returned frame
    still reads stays until the shared folder is cleaned.
    """

    def __init__(self, spark: SparkSession, name: str):
        importable(spark)
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def released(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``task`` for mapInArrow; at its end what it has freed goes back to the system, so that workers that
    wait for the next stage, or serve another one, do not hold the most that any stage ever took."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library keeps its memory
                pass
    return run


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each piece (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = max(1, batch.column(column).nbytes)
        step = max(1, n * limit // size) if size > limit else n
        for at in range(0, n, step):
            yield batch.slice(at, step)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal ``key`` of rows that come ordered by it; groups are bounded by their makers."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        keys = np.asarray(batch.column(key))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, z in zip(cuts, cuts[1:]):
            if held and keys[a] != held_key:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(a, z - a))
            held_key = keys[a]
    if held:
        yield pa.concat_tables(held)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def components(scratch: Scratch, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected link table: (id, component), component = smallest id.

    Large-star / small-star contraction; every round is two aggregations and two
    equi-joins, written to the shared folder. Minima are taken by partial aggregates and
    written first, so that both sides of the joins back are plain sorted shuffles, whose
    hot partitions adaptive execution splits: the links of one vertex are no single task.
    Self links and repeated links do no harm; no links give an empty table.
    """
    edges = scratch.write(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        large = scratch.write(large, "large")
        scratch.drop(low)
        low = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        small = scratch.write(small, "small")
        scratch.drop(edges, large, low)
        edges = small
        # a forest of stars: no root hangs below another vertex
        hanging = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
        if hanging.isEmpty():
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
