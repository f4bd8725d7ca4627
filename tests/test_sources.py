from stratum.operators import models
from stratum.sources import tables


def test_lookup_csv_declared_types(spark, tmp):
    path = f"{tmp}/zones.csv"
    with open(path, "w") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                 '264,"Unknown","N/A","N/A"\n')
    zones = models.stg_zones(tables.read_lookup(spark, path, tables.ZONES_DDL))
    rows = {r.location_id: r for r in zones.collect()}
    assert rows[264].zone_name == "N/A" and rows[1].borough == "EWR"
    assert dict(zones.dtypes)["location_id"] == "bigint"


def test_first_rows(spark):
    df = spark.range(100).selectExpr("id", "100 - id AS k").coalesce(1)
    got = [r.k for r in tables.first_rows(df, 3, ["k"]).collect()]
    assert got == [1, 2, 3]
    assert tables.first_rows(df, 0, ["k"]).count() == 100


def test_scan_with_declared_columns(spark, tmp):
    spark.range(3).selectExpr("id", "id * 2 AS b", "'x' AS c").write.parquet(f"{tmp}/t")
    out = tables.scan(spark, f"{tmp}/t", "b BIGINT, missing STRING")
    assert sorted((r.b, r.missing) for r in out.collect()) == [(0, None), (2, None), (4, None)]


def test_only_a_single_split_is_dealt(spark):
    one = spark.range(0, 100, numPartitions=1)
    assert tables.deal_single_split(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    two = spark.range(0, 100, numPartitions=2)
    assert tables.deal_single_split(two) is two


def test_an_input_of_one_row_group_in_many_splits_is_dealt(spark, tmp):
    """The rows of a row group are read by one task, however many splits its bytes give."""
    from pyspark.sql import functions as F

    name, cores = "spark.sql.files.maxPartitionBytes", spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    spark.range(0, 50_000, numPartitions=1).selectExpr("id", "md5(CAST(id AS STRING)) AS v").write.parquet(f"{tmp}/one")
    spark.range(0, 50_000, numPartitions=2 * cores).selectExpr("id", "md5(CAST(id AS STRING)) AS v").write.parquet(f"{tmp}/many")
    spark.conf.set(name, "100k")
    try:
        one, many = spark.read.parquet(f"{tmp}/one"), spark.read.parquet(f"{tmp}/many")
        assert one.rdd.getNumPartitions() > cores
        dealt = tables.deal_single_split(one)
        most = max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
        assert most * cores <= 2 * 50_000 and dealt.exceptAll(one).isEmpty() and dealt.count() == 50_000
        assert tables.deal_single_split(many) is many
    finally:
        spark.conf.set(name, before)
