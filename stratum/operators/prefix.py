"""Running totals without a single task (WN2): a two-level prefix sum.

The rows are dealt to ranges of the order columns and staged, with the number of their
range. The sums of the ranges, one row each, give every range its offset; inside a range
an ordinary window adds up. Only the row per range passes through one task. Rows that
are equal in all order columns stay in one range, so the order should end in a column
that tells rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"


def ranged(df: DataFrame, order: Sequence[str], stage: str, ranges: int | None = None) -> DataFrame:
    """``df`` staged at ``stage`` with ``_range``, ascending in the order columns."""
    spark = df.sparkSession
    n = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order]).withColumn(RANGE, F.spark_partition_id())
    dealt.write.parquet(stage)
    return spark.read.schema(dealt.schema).parquet(stage)


def running_totals(df: DataFrame, order: Sequence[str], values: dict[str, str | Column], stage: str,
                   ranges: int | None = None) -> DataFrame:
    """``df`` with a running total (this row included) per entry of ``values``: name → what is added up.

    NULLs count as nothing; a total is NULL only before the first value. Exact for integers and
    decimals; of doubles the order of addition is by range. The stage must outlive the result.
    """
    staged = ranged(df.select("*", *[(F.col(v) if isinstance(v, str) else v).alias(f"_v_{name}") for name, v in values.items()]), order, stage, ranges)
    sums = staged.groupBy(RANGE).agg(*[F.sum(f"_v_{name}").alias(f"_s_{name}") for name in values])
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = sums.select(RANGE, *[F.sum(f"_s_{name}").over(before).alias(f"_o_{name}") for name in values])
    inside = Window.partitionBy(RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    totals = []
    for name in values:
        own, earlier = F.sum(f"_v_{name}").over(inside), F.col(f"_o_{name}")
        totals.append(F.when(own.isNull(), earlier).otherwise(own + F.coalesce(earlier, F.lit(0))).alias(name))
    return staged.join(offsets, RANGE).select(*df.columns, *totals)


def running_numbers(df: DataFrame, order: Sequence[str], stage: str, name: str = "number", ranges: int | None = None) -> DataFrame:
    """``df`` with its row numbers from 1 in the order of the columns."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, stage, ranges)
