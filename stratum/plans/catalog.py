"""Registry of the queries exposed to the driver: name → (spark, sf_dir) → DataFrame.

Each query runs its operator over the whole driver tables (see
``bindings`` for how the tables are shaped into pipeline inputs).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.plans import oracle as oracle_sql
from stratum.session import configure
from stratum.plans.taxi import TripPlan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    """Register ``fn`` under ``name``; the session gets the package settings
    (UTC, ANSI, AQE) before the plan is built."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _plan_node(name: str, attr: str | None = None) -> None:
    attr = attr or name

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(TripPlan(spark, sf_dir), attr)

    run.__name__ = f"q_{name}"
    register(name)(run)


for _name, _attr in [
    ("silver_pipeline", "silver"), ("stg_trips", None), ("trip_metrics", None), ("fct_trips", None),
    ("daily_summary", None), ("hourly_patterns", None), ("mart_hourly_demand", None),
    ("mart_location_performance", None), ("dim_dates", None), ("mart_daily_revenue", None),
    ("dim_locations", None),
]:
    _plan_node(_name, _attr)


from stratum.plans import queries, queries_tables  # noqa: E402,F401  (register the operator queries)


def oracle() -> dict[str, str]:
    return {k: v for k, v in oracle_sql.sql().items() if k in QUERIES}
