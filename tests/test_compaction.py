"""File-selective compaction (MT1)."""

import os

from pyspark.sql import functions as F

from stratum.sinks import compaction


def _files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _table(spark, path, appends=6):
    rows = spark.range(6000).select(F.col("id").alias("k"), F.expr("CASE WHEN id % 5 = 0 THEN NULL ELSE concat('0', id % 3) END").alias("d"), F.expr("repeat(md5(string(id)), 4)").alias("v"))
    for i in range(appends):
        (rows.where(f"k >= {i * 1000} AND k < {(i + 1) * 1000}" + (" AND (d <> '02' OR d IS NULL)" if i else "")).coalesce(1).sortWithinPartitions("k")
         .write.mode("append").partitionBy("d").parquet(path))


def test_bins_order_and_untouched_files(spark, tmp):
    path = f"{tmp}/t"
    _table(spark, path)
    read = lambda: spark.read.schema("k long, v string, d string").parquet(path)
    before, rows = _files(path), sorted(map(tuple, read().collect()), key=str)
    one = max(before.values())
    small = one + 1
    target = 3 * one
    replaced = compaction.compact(spark, path, "d", target_file_bytes=target, small_file_bytes=small)
    after = _files(path)
    assert sorted(map(tuple, read().collect()), key=str) == rows
    assert replaced == 18  # six files each of '00', '01' and NULL; '02' has a single file, which stays
    assert {f for f in before if "d=02" in f} <= set(after)
    new = set(after) - set(before)
    assert len(new) == 6 and all(after[f] <= 1.2 * target for f in new)  # two bins of three files a folder
    assert any("__HIVE_DEFAULT_PARTITION__" in f for f in new)
    for f in new:  # the files follow one another, each in its own order
        ks = [r.k for r in spark.read.parquet(f).select("k").collect()]
        assert sum(x > y for x, y in zip(ks, ks[1:])) <= 2 and len({k // 1000 for k in ks}) == 3
        assert all(x // 1000 != y // 1000 for x, y in zip(ks, ks[1:]) if x > y)
    assert compaction.compact(spark, path, "d", target, small_file_bytes=one // 2) == 0 and _files(path) == after
    assert not os.path.exists(f"{path}.compaction")


def test_recovery_of_a_compaction_cut_off(spark, tmp):
    path = f"{tmp}/t"
    _table(spark, path, appends=2)
    before = _files(path)
    old = [f for f in before if "d=00" in f]
    rows = spark.read.parquet(path).count()
    merged = old[0].rsplit("/", 1)[0] + "/compacted-x-00000-c000.snappy.parquet"
    log = lambda: spark.createDataFrame([("new", f"file:{merged}", "file:/gone")] + [("old", f"file:{f}", None) for f in old],
                                        "kind string, file string, source string").write.mode("overwrite").parquet(f"{path}.compaction")
    log()  # nothing was moved yet: the old files stay
    assert compaction.recover(spark, path) and _files(path) == before
    spark.read.parquet(*old).coalesce(1).write.parquet(f"{tmp}/merged")
    os.rename(next(iter(_files(f"{tmp}/merged"))), merged)
    log()  # everything was moved: the old files go
    assert compaction.recover(spark, path) and spark.read.parquet(path).count() == rows
    assert set(_files(path)) == (set(before) - set(old)) | {merged}
    assert not compaction.recover(spark, path)


def test_next_fit(spark):
    files = spark.createDataFrame([("a", f"f{i}", b) for i, b in enumerate((4, 4, 4, 9, 2, 2, 50, 3))] + [("b", "x", 1)], "folder string, file string, bytes long")
    got = {r.file: r.bin for r in compaction.next_fit(files, 10, 40).collect()}
    assert got == {"f0": 0, "f1": 0, "f4": 3, "f5": 3, "f7": 3}  # f2 and f3 are alone in their bins, f6 is good
