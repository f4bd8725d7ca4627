"""Every registered query on the smallest driver tables, against its SQL where it has one."""

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[0] == "trip_id" and df.columns[-1] == "pickup_date"
    assert df.count() > 0


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    sql = E.oracle_sql().get(name)
    rows = df.collect()
    if sql is None:
        assert rows
        return
    result = duck.sql(sql)
    assert sorted(result.columns) == sorted(df.columns)
    expect = [dict(zip(result.columns, r, strict=True)) for r in result.fetchall()]
    assert rows_of([r.asDict() for r in rows], df.columns, 9) == rows_of(expect, df.columns, 9)


def test_daily_revenue_has_every_day_of_the_trips(spark):
    from stratum.plans.taxi import TripPlan

    plan = TripPlan(spark, SF)
    days = {r.pickup_date for r in plan.daily_summary.select("pickup_date").collect()}
    rows = plan.mart_daily_revenue.select("date_key", "total_trips").collect()
    assert {r.date_key for r in rows} == days and sum(r.total_trips for r in rows) == plan.trip_metrics.count()
