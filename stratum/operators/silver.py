"""Bronze → Silver: quality filters (FLT1, FLT2), latest-wins de-duplication
(DD1), the typed projection with surrogate key and partition date
(PRJ5–PRJ7) and their composition (SIL1).

Plan shape of ``silver()``: one scan with the filters pushed to it, one
shuffle on the de-dup key (pre-limited to one row per key and map task by a
partial ``WindowGroupLimit``), then per-row projections.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import hash_key
from stratum.manifest import Manifest, spark_type


# ------------------------------------------------------------------ filters
def filter_condition(filters: Sequence[str | Column]) -> Column:
    """AND of SQL predicates; a predicate that is NULL rejects the row."""
    cols = [F.expr(f) if isinstance(f, str) else f for f in filters]
    return reduce(lambda a, b: a & b, cols)


def quality_filter(df: DataFrame, filters: Sequence[str | Column]) -> DataFrame:
    """Rows for which every quality predicate is TRUE (FLT1)."""
    if not filters:
        return df
    return df.filter(filter_condition(filters))


# ------------------------------------------------------------------- de-dup
def dedup_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ("ingestion_ts",),
                 tiebreak: bool = True) -> DataFrame:
    """One row per key: the one with the greatest ``latest_by`` values (DD1, WN1).

    With ``tiebreak`` every other column is appended ascending (NULLs first)
    so the winner is the same on every run even when ``latest_by`` ties (all
    rows of one batch share ``ingestion_ts``). NULL keys form one group.

    Spark plans ``row_number() … = 1`` with a partial ``WindowGroupLimit``
    before the shuffle, so a hot key ships at most one row per map task.
    """
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    if tiebreak:
        used = set(keys) | set(latest_by)
        order += [F.col(c).asc_nulls_first() for c in df.columns if c not in used]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


# --------------------------------------------------------------- projection
def surrogate_key(manifest: Manifest, df: DataFrame | None = None) -> Column:
    """MD5 over the manifest's surrogate-key fields (PRJ6), NULL → ``''``."""
    types = {c.name: spark_type(c.bronze_type) for c in manifest.columns}
    if df is not None:
        types.update({f.name: f.dataType for f in df.schema.fields})
    return hash_key([(F.col(f), types[f]) for f in manifest.surrogate_key_fields])


def silver_columns(manifest: Manifest, df: DataFrame | None = None) -> list[Column]:
    """Silver projection: key first, renamed/typed columns, ``ingestion_ts``,
    partition date last (PRJ5, PRJ7). A value that does not fit its Silver
    type becomes NULL instead of failing the job."""
    cols = [surrogate_key(manifest, df).alias(manifest.resolved_surrogate_key_name)]
    for c in manifest.columns:
        src = spark_type(c.bronze_type)
        dst = spark_type(c.silver_type)
        expr = F.col(c.name) if src == dst else F.col(c.name).try_cast(dst)
        cols.append(expr.alias(c.silver_output_name))
    cols.append(F.col("ingestion_ts").cast(T.TimestampNTZType()).alias("ingestion_ts"))
    cols.append(F.expr(manifest.partition_date_expr).cast("date").alias(manifest.partition_date_col))
    return cols


def silver_project(df: DataFrame, manifest: Manifest) -> DataFrame:
    return df.select(*silver_columns(manifest, df))


def silver(bronze: DataFrame, manifest: Manifest) -> DataFrame:
    """Bronze → Silver rows (SIL1): filter, keep the latest row per de-dup
    key, then project. Lazy; nothing runs until a sink acts."""
    filtered = quality_filter(bronze, manifest.quality_filters)
    latest = dedup_latest(filtered, manifest.dedup_key, ("ingestion_ts",))
    return silver_project(latest, manifest)
