"""Mergeable key state for row accounting (RC7).

A batch leaves a small state: its row counts, and the exact set of its passing keys as
bitmaps (a bucket of 32 768 neighbouring integers is one bitmap of 4 KB). States of many
batches merge by adding the counts and or-ing the bitmaps of a bucket, so the accounting
of a new batch reads no earlier rows. Both steps are partial aggregates.

The key is an integer whose values lie close together (numbers given in sequence, or made
of such); of scattered ones, such as hashes, every key would cost a bitmap, and
``reconcile.row_accounting`` fits better. A NULL key counts as one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.silver import filter_condition

STATE_SCHEMA = "batch STRING, bucket BIGINT, keys BINARY, bronze_rows BIGINT, passing_rows BIGINT"


def batch_state(rows: DataFrame, batch: str, filters: Sequence[str], key: Column) -> DataFrame:
    """(batch, bucket, keys, bronze_rows, passing_rows): a row per bucket; a NULL bucket holds rows without a key
    or that do not pass."""
    ok = F.coalesce(filter_condition(filters), F.lit(False))
    passing = F.when(ok, key)
    marked = rows.select(ok.alias("ok"), F.bitmap_bucket_number(passing).alias("bucket"), F.bitmap_bit_position(passing).alias("bit"))
    return marked.groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("keys"), F.count(F.lit(1)).alias("bronze_rows"), F.count_if("ok").alias("passing_rows")).select(
        F.lit(batch).alias("batch"), "bucket", F.when(F.col("bucket").isNotNull(), F.col("keys")).alias("keys"), "bronze_rows", "passing_rows")


def accounting(states: DataFrame) -> DataFrame:
    """The columns of ``reconcile.row_accounting`` from the states of any batches; a batch that was written
    again counts once, with its last state (they are equal)."""
    once = states.dropDuplicates(["batch", "bucket"])
    merged = once.groupBy("bucket").agg(F.bitmap_or_agg("keys").alias("keys"), F.sum("bronze_rows").alias("n"), F.sum("passing_rows").alias("ok"))
    # rows that pass without a key are in the NULL bucket, and are one key
    distinct = F.when(F.col("bucket").isNotNull(), F.bitmap_count("keys")).otherwise((F.col("ok") > 0).cast("long"))
    out = merged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"), F.coalesce(F.sum("ok"), F.lit(0)).alias("passing_rows"),
                     F.coalesce(F.sum(distinct), F.lit(0)).alias("silver_rows"))
    return out.select("bronze_rows", "passing_rows", "silver_rows", (F.col("bronze_rows") - F.col("passing_rows")).alias("filtered_rows"),
                      (F.col("passing_rows") - F.col("silver_rows")).alias("deduplicated_rows"))
