"""Table sources: Parquet scans (SRC1, SRC7), CSV lookups with declared
types (SRC6) and the row cap of the producer (SRC2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet table (file or directory); with a schema, columns are read
    by name with the declared types and nothing is inferred."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def deal_single_split(df: DataFrame) -> DataFrame:
    """Deal an input that few of its splits hold over the session's cores, before per-row work such as JSON.

    A row group cannot be split: its rows are all read by one task, and the other splits of its bytes
    are empty. So what counts is not the number of splits but the rows that each has, which the
    footers tell without reading a column. An input is dealt when its largest split has over twice an
    even share of a core; one that is spread over the cores is returned as it is, and never shuffled.
    """
    splits, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    if splits > 1:
        rows = df.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
        if not rows["all"] or rows["most"] * cores <= 2 * rows["all"]:
            return df
    return df.repartition(max(splits, cores))


def first_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """SRC2: the first ``n`` rows by a total order (``n = 0`` means all).

    File order is not stable under parallel reads, so "first" needs an
    explicit key. Spark plans this as a per-partition top-N followed by one
    merge of at most ``n × tasks`` rows (TakeOrderedAndProject), never a
    full sort.
    """
    if n <= 0:
        return df
    return df.orderBy(*order_by).limit(n)


def read_lookup(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """SRC6: a CSV lookup with header and declared column types. Values are
    read as text where declared so (e.g. the literal ``N/A`` stays a string)."""
    return spark.read.schema(ddl).option("header", True).option("mode", "FAILFAST").csv(path)


# Declared types of the trip lookups (seeds).
ZONES_DDL = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
PAYMENT_TYPES_DDL = "payment_type_id INT, payment_type_name STRING"
RATE_CODES_DDL = "rate_code_id INT, rate_code_name STRING"
VENDORS_DDL = "vendor_id INT, vendor_name STRING, vendor_abbr STRING"
