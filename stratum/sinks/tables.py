"""Table writes on plain Parquet directories: Bronze append (SNK4), Silver
partitioned write (SNK5), namespaces (SNK6), delete+insert upsert and the
high-water incremental filter (UP1–UP4) and full refresh (UP3).

Every write goes through Spark's file commit protocol, so a lost executor
only re-runs its tasks. Replacing data that is also being read (the upsert) never overwrites the source path directly: the new partitions
are first written to a staging table under ``spark.checkpoint.dir`` (which
also cuts the lineage), then swapped in with a dynamic partition overwrite
that touches only those partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stratum.manifest import Manifest
from stratum.session import checkpoint_dir

#: Fixed value: the folder name that stands for NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def layer_path(warehouse: str, table: str) -> str:
    """``<warehouse>/<schema>/<table>`` for ``schema.table``."""
    schema, name = table.split(".", 1)
    return f"{warehouse.rstrip('/')}/{schema}/{name}"


def ensure_namespaces(spark: SparkSession, warehouse: str, schemas: Sequence[str] = ("bronze", "silver")) -> None:
    """SNK6: one directory (and catalog database) per layer."""
    for s in schemas:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {s} LOCATION '{warehouse.rstrip('/')}/{s}'")


def append_bronze(df: DataFrame, path: str) -> None:
    """SNK4: append-only, unpartitioned, no filtering."""
    df.write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_col: str, mode: str = "overwrite",
                      rebalance: bool = True) -> None:
    """SNK5: date-partitioned Parquet. ``overwrite`` replaces only the
    partitions present in ``df`` (dynamic partition overwrite).

    The rows are rebalanced on the partition column first: with AQE a hot
    date is split over several tasks and small dates are coalesced, so each
    task writes files for few dates and no task holds a whole hot date.
    """
    if rebalance:
        df = df.hint("rebalance", partition_col)
    (df.write
     .option("partitionOverwriteMode", "dynamic")
     .mode(mode).partitionBy(partition_col).parquet(path))


def write_silver(df: DataFrame, manifest: Manifest, warehouse: str, full: bool = False) -> str:
    """Silver: the partitions computed replace theirs; ``full`` replaces the whole table, so that dates
    without rows any more go."""
    path = layer_path(warehouse, manifest.silver_table)
    drop_key_indexes(df.sparkSession, path)
    if full:
        full_refresh(df.hint("rebalance", manifest.partition_date_col), path, manifest.partition_date_col)
    else:
        write_partitioned(df, path, manifest.partition_date_col)
    return path


def full_refresh(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """UP3: rebuild the whole table."""
    drop_key_indexes(df.sparkSession, path)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(partition_col) if partition_col else w).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """False only if there is no such path or no file in it; any other failure is raised, as a table that
    cannot be read must not be taken for a new one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return False
    try:
        spark.read.parquet(path).schema  # noqa: B018 - raises when missing
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def staging_path(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/staging/{tag}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ upsert
def schema_mismatch(incoming: DataFrame, target: DataFrame) -> list[str]:
    """UP4: differences between incoming and target schema (name:type)."""
    a = {f.name: f.dataType.simpleString() for f in incoming.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    return sorted({f"{k}:{a.get(k)}!={b.get(k)}" for k in set(a) | set(b) if a.get(k) != b.get(k)})


def merge_by_key(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """UP1 as a DataFrame: target rows whose key is not in ``batch``, plus
    all of ``batch`` (delete+insert). The anti-join shuffles the batch's
    distinct keys, not its rows."""
    keys = [key] if isinstance(key, str) else list(key)
    batch_keys = batch.select(*keys).distinct()
    return target.join(batch_keys, keys, "left_anti").unionByName(batch)


def in_partitions(column: str | Column, values: Sequence) -> Column:
    """Whether a partition column has one of the values, NULL among them: literals, so a scan is pruned by it."""
    c = F.col(column) if isinstance(column, str) else column
    some = c.isin([v for v in values if v is not None])
    return (some | c.isNull()) if None in values else some


def read_target(spark: SparkSession, path: str, like: DataFrame, partition_col: str) -> DataFrame:
    """The table at ``path``. The type of the partition column is read from folder names, which tell
    nothing when NULL is its only value; then it is the type that ``like`` has."""
    target = spark.read.parquet(path)
    wanted = like.schema[partition_col].dataType if partition_col in like.columns else None
    if wanted is not None and target.schema[partition_col].dataType != wanted and partition_values(target, partition_col) in ([], [None]):
        fields = [f if f.name != partition_col else StructField(f.name, wanted) for f in target.schema.fields]
        target = spark.read.schema(StructType(fields)).parquet(path)
    return target


def upsert_by_key(spark: SparkSession, path: str, batch: DataFrame, key: str | Sequence[str],
                  partition_col: str, moves: bool = False) -> None:
    """UP1 on a partitioned Parquet table.

    The batch is evaluated once, into a stage; its distinct partition values (a bounded set of
    dates, NULL among them) become literals, so the scan of the target prunes to those partitions, and
    only they are rewritten. ``moves`` says that a key's rows may lie in another partition than the
    batch has them in: then the partitions that hold batch keys are rewritten too, which the table's
    key index tells (see ``key_index``).

    The merged partitions are staged under ``spark.checkpoint.dir``, then swapped in by a dynamic
    overwrite. That replaces files partition by partition when the job commits: a reader that
    lists the table during the commit can see some partitions old and some new, and retries or
    reads before and after it see one state. Stages are removed at the end.
    """
    from stratum.sinks.key_index import KeyIndex

    keys = [key] if isinstance(key, str) else list(key)
    index = KeyIndex(spark, path, keys, partition_col)
    if not moves and not _exists(spark, index.path):
        index = None  # an index that is there is kept up, whoever writes
    if not _exists(spark, path):
        write_partitioned(batch, path, partition_col)
        if index:
            index.build()
        return
    target = read_target(spark, path, batch, partition_col)
    diff = schema_mismatch(batch, target)
    if diff:
        raise ValueError(f"schema change in incremental write: {diff}")
    batch_stage, merged_stage = staging_path(spark, "batch"), staging_path(spark, "upsert")
    batch.write.parquet(batch_stage)
    staged = spark.read.schema(batch.schema).parquet(batch_stage)
    touched = partition_values(staged, partition_col)
    if index:
        touched = sorted({*touched, *index.announce(staged)}, key=lambda v: (v is not None, v))
    if touched:
        affected = target.filter(in_partitions(partition_col, touched))
        write_partitioned(merge_by_key(affected, staged, key), merged_stage, partition_col)
        merged = spark.read.schema(target.schema).parquet(merged_stage)
        write_partitioned(merged, path, partition_col, rebalance=False)
        # a partition whose rows have all moved away is not among those overwritten
        left = set(partition_values(merged, partition_col))
        for gone in (v for v in touched if v not in left):
            remove(spark, f"{path.rstrip('/')}/{partition_col}={NULL_PARTITION if gone is None else gone}")
    if index:
        index.settle()
    remove(spark, batch_stage, merged_stage)


def partition_values(df: DataFrame, partition_col: str) -> list:
    """Distinct values of a partition column, as literals for pruning: one row per partition, NULL first."""
    return sorted((r[0] for r in df.select(partition_col).distinct().collect()), key=lambda v: (v is not None, v))


def drop_key_indexes(spark: SparkSession, path: str) -> None:
    """Writes that do not keep up a table's key index remove it; the next upsert that needs one builds it anew."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.keys-*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    remove(spark, *[f.getPath().toString() for f in found or []])


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete staging folders, on whatever file system they are."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def incremental_rows(incoming: DataFrame, target: DataFrame | None, ts_col: str,
                     lookback: str | None = None, date_col: str | None = None) -> DataFrame:
    """UP2: rows strictly later than the newest ``ts_col`` of the target
    (minus an optional look-back interval such as ``"2 hours"``); all rows
    when the target does not exist yet. ``date_col``, the date of ``ts_col`` by which
    the incoming table is partitioned, adds a predicate that prunes its partitions."""
    if target is None:
        return incoming
    hwm = target.agg(F.max(ts_col)).first()[0]
    if hwm is None:
        return incoming
    bound = F.lit(hwm)
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    later = incoming.filter(F.col(ts_col) > bound)
    if date_col:
        # the bound is evaluated here, so that the date predicate is a literal
        first = incoming.sparkSession.range(1).select(F.to_date(bound)).first()[0]
        later = later.filter(F.col(date_col) >= F.lit(first))
    return later
