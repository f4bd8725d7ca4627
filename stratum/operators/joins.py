"""Referential anti-joins (JN3). No join in this package carries a broadcast hint
for data that can grow: adaptive execution measures the bytes of a side and turns a
shuffle join into a broadcast only below the session's threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL child keys without a parent row, with their row counts: ``(child_key, n_rows)``.

    Rows are counted per key before the join (partial aggregation), so the shuffle
    carries one row per key and map task however skewed the child is.
    """
    per_key = (child.select(F.col(child_key).alias("_k")).filter(F.col("_k").isNotNull())
               .groupBy("_k").agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(parent_key).alias("_p")).distinct()
    return (per_key.join(parents, per_key["_k"] == parents["_p"], "left_anti")
            .select(F.col("_k").alias(child_key), "n_rows"))
