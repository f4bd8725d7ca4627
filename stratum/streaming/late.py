"""Late events as data (ST3).

A micro-batch starts with the watermark that the newest event time of all earlier batches
gives, to the millisecond, less the allowed delay; it never goes back. A stateful operator
tests its rows with the watermark that the batch before started with, so batch n sees the
events of batches up to n - 2. A row at or before that time is late and dropped by the
stream: here this is replayed over the batches, so that every such row can be seen,
counted or corrected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_watermarks(rows: DataFrame, batch_col: str, event_col: str, seconds: int) -> DataFrame:
    """(batch, watermark): one row per micro-batch; the watermark of the first two is the epoch."""
    newest = rows.groupBy(batch_col).agg(F.max(F.unix_millis(F.col(event_col).cast("timestamp"))).alias("_ms"))
    earlier = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -2)  # a row per batch
    ms = F.greatest(F.lit(0), F.coalesce(F.max("_ms").over(earlier) - 1000 * seconds, F.lit(0)))
    return newest.select(batch_col, F.timestamp_millis(ms).alias("watermark"))


def late_ledger(rows: DataFrame, batch_col: str, event_col: str, seconds: int) -> DataFrame:
    """``rows`` with ``watermark`` (of their batch) and ``late``; rows without an event time are on time."""
    marks = batch_watermarks(rows, batch_col, event_col, seconds)
    late = F.coalesce(F.col(event_col).cast("timestamp") <= F.col("watermark"), F.lit(False))
    return rows.join(marks, batch_col).select(*rows.columns, "watermark", late.alias("late"))
