"""Compaction of a partitioned Parquet table, file by file (MT1).

Per partition the small files are packed into bins by next fit: in order of their names a
bin is filled until the next file would take it past the target size. Only bins of two or
more files are rewritten; good files, and partitions without such bins, are not touched.

A bin becomes one file: its rows are dealt by the file that they come from and written in
the order of these files and of the rows in them, so the order inside the files, and with
it the row-group statistics, survive.

New files go to a stage first. Then they are appended to the table's folders and the files
that they replace are deleted. A failure before the deletion leaves rows twice, so the
pairs are recorded in a log beside the table before anything is appended, and the next
run (or ``recover``) ends or takes back what the log says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.sinks.tables import _exists, remove, staging_path

TARGET_FILE_BYTES = 128 * 1024 * 1024
SMALL_FILE_BYTES = 32 * 1024 * 1024


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, file, bytes) of the table's Parquet files, from a listing that reads no data."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
             .select(F.col("path").alias("file"), F.col("length").alias("bytes")))
    return files.select(F.expr("substring(file, 1, length(file) - length(substring_index(file, '/', -1)) - 1)").alias("folder"), "file", "bytes")


def next_fit(files: DataFrame, target_file_bytes: int, small_file_bytes: int) -> DataFrame:
    """(folder, file, bytes, bin) of the small files that share a bin with others.

    The bins of one folder follow one another, so they come from a fold over its sorted small files: (file
    names and sizes of one folder, which a listing holds in any case)."""
    small = files.where(F.col("bytes") < small_file_bytes)
    lists = small.groupBy("folder").agg(F.sort_array(F.collect_list(F.struct("file", "bytes"))).alias("files"))
    fold = f"""aggregate(files, named_struct('bin', 0L, 'held', 0L, 'bins', CAST(array() AS ARRAY<STRUCT<file: STRING, bytes: BIGINT, bin: BIGINT>>)), (a, f) ->
        IF(a.held > 0 AND a.held + f.bytes > {target_file_bytes},
           named_struct('bin', a.bin + 1, 'held', f.bytes, 'bins', concat(a.bins, array(named_struct('file', f.file, 'bytes', f.bytes, 'bin', a.bin + 1)))),
           named_struct('bin', a.bin, 'held', a.held + f.bytes, 'bins', concat(a.bins, array(named_struct('file', f.file, 'bytes', f.bytes, 'bin', a.bin))))), a -> a.bins)"""
    placed = lists.select("folder", F.inline(F.expr(fold)))
    members = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))
    return placed.withColumn("members", members).where("members > 1").drop("members")


def compact(spark: SparkSession, path: str, partition_col: str,
            target_file_bytes: int = TARGET_FILE_BYTES, small_file_bytes: int = SMALL_FILE_BYTES) -> int:
    """Pack the small files; returns the number of files that were replaced. The row set is unchanged."""
    recover(spark, path)
    stage, log = staging_path(spark, "compact"), f"{path.rstrip('/')}.compaction"
    binned = next_fit(list_files(spark, path), target_file_bytes, small_file_bytes)
    number = F.dense_rank().over(Window.orderBy("folder", "bin")) - 1  # a row per file to replace
    binned.withColumn("no", number).write.parquet(f"{stage}/plan")
    plan = spark.read.parquet(f"{stage}/plan")
    bins = {r.no: r.folder for r in plan.select("no", "folder").distinct().collect()}
    if not bins:
        remove(spark, stage)
        return 0
    replaced = [r[0] for r in plan.select("file").collect()]  # names, which the read and the deletion need one by one
    rows = spark.read.option("basePath", path).parquet(*replaced)
    columns = [c for c in rows.columns if c != partition_col]
    placed = (rows.select(F.struct(*columns).alias("row"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
              .join(plan.select("file", "no"), "file"))
    # each bin is one task, whose number is the bin's and names its file
    (placed.repartitionById(len(bins), "no").sortWithinPartitions("file", "place").select("row.*")
     .write.parquet(f"{stage}/data"))
    # what is to come and to go, before either happens
    tag = uuid.uuid4().hex
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    made = [r[0] for r in list_files(spark, f"{stage}/data").select("file").collect()]
    moves = []
    for src in made:
        part = src.split("/")[-1].split("-")
        moves.append((src, f"{bins[int(part[1])]}/compacted-{tag}-{part[1]}-{part[-1]}"))
    spark.createDataFrame([("new", dst, src) for src, dst in moves] + [("old", f, None) for f in replaced], "kind string, file string, source string") \
         .coalesce(1).write.mode("overwrite").parquet(log)
    for src, dst in moves:
        source = fs.Path(src)
        source.getFileSystem(conf).rename(source, fs.Path(dst))
    remove(spark, *replaced)
    remove(spark, log, stage)
    return len(replaced)


def recover(spark: SparkSession, path: str) -> bool:
    """End a compaction that was cut off: if all new files are in place the old ones go, else the new ones go. True if there was one."""
    log = f"{path.rstrip('/')}.compaction"
    if not _exists(spark, log):
        return False
    entries = spark.read.parquet(log).collect()
    new, old = ([r.file for r in entries if r.kind == k] for k in ("new", "old"))
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    there = lambda f: (p := fs.Path(f)).getFileSystem(conf).exists(p)
    # sources that were moved are gone; a new file counts only if nothing is left to move
    remove(spark, *(old if all(map(there, new)) else new))
    remove(spark, log)
    return True
