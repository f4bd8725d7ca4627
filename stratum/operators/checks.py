"""Data tests (DT1–DT11), the rule audit (QG3) and range checks derived from
quality filters (QG4).

Row-level tests of one table (not_null, accepted_values, accepted_range,
positive_value, expression tests) are evaluated in **one aggregation pass**:
each test is a conditional count, so the whole check set costs one scan and
a single-row global aggregate. ``unique`` and ``relationships`` need a shuffle
each; both shuffle keys with map-side combining, never whole rows.

Results are one DataFrame with the schema ``RESULT_SCHEMA``.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import round_half_away
from stratum.manifest import Manifest
from stratum.operators.joins import orphan_keys

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("severity", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("passed", T.BooleanType()),
])


@dataclass(frozen=True)
class Check:
    """One data test. ``kind`` is one of ``not_null``, ``unique``,
    ``accepted_values``, ``accepted_range``, ``positive_value``,
    ``expression`` (a SQL predicate that is TRUE for *failing* rows),
    ``relationships``."""

    kind: str
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    min_value: float | int | None = None
    max_value: float | int | None = None
    inclusive: bool = True
    expression: str | None = None
    name: str | None = None
    parent: DataFrame | None = field(default=None, compare=False)
    parent_column: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", column, severity)


def unique(column: str, severity: str = "error") -> Check:
    return Check("unique", column, severity)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Check:
    return Check("accepted_values", column, severity, values=tuple(values))


def accepted_range(column: str, min_value=None, max_value=None, inclusive: bool = True,
                   severity: str = "error") -> Check:
    return Check("accepted_range", column, severity, min_value=min_value, max_value=max_value,
                 inclusive=inclusive)


def positive_value(column: str, severity: str = "error") -> Check:
    return Check("positive_value", column, severity)


def expression(name: str, failing_when: str, severity: str = "error") -> Check:
    return Check("expression", None, severity, expression=failing_when, name=name)


def relationships(column: str, parent: DataFrame, parent_column: str,
                  severity: str = "error") -> Check:
    return Check("relationships", column, severity, parent=parent, parent_column=parent_column)


# ------------------------------------------------------------ row-level tests
def failing(check: Check) -> Column:
    """Predicate that is TRUE exactly for the rows a row-level test fails on."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "accepted_range":
        ok = F.lit(True)
        if check.min_value is not None:
            ok = ok & ((c >= F.lit(check.min_value)) if check.inclusive else (c > F.lit(check.min_value)))
        if check.max_value is not None:
            ok = ok & ((c <= F.lit(check.max_value)) if check.inclusive else (c < F.lit(check.max_value)))
        return c.isNotNull() & ~ok
    if check.kind == "positive_value":
        return c < 0
    if check.kind == "expression":
        return F.coalesce(F.expr(check.expression), F.lit(False))
    raise ValueError(f"not a row-level check: {check.kind}")


ROW_LEVEL = {"not_null", "accepted_values", "accepted_range", "positive_value", "expression"}


def _result(model: str, label: str, column: str | None, failures: Column, severity: str) -> Column:
    passed = failures == 0
    status = (F.when(passed, F.lit("pass"))
              .when(F.lit(severity) == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return F.struct(F.lit(model).alias("model"), F.lit(label).alias("check"),
                    F.lit(column).cast("string").alias("column"),
                    failures.cast("bigint").alias("failures"), F.lit(severity).alias("severity"),
                    status.alias("status"), (passed | (F.lit(severity) == "warn")).alias("passed"))


def run_row_checks(df: DataFrame, checks: Sequence[Check], model: str, unique: Check | None = None) -> DataFrame:
    """All row-level checks of one table in one aggregation pass, and one ``unique`` check with them.

    With ``unique``, rows are first counted per value of its column (partial aggregates, so a hot
    value ships one row per task) together with their failures, then the counts are added up:
    the table is still evaluated once.
    """
    checks = [c for c in checks if c.kind in ROW_LEVEL]
    if not checks and unique is None:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    names = [f"_f{i}" for i in range(len(checks))]
    failures = [F.count_if(failing(c)).alias(n) for n, c in zip(names, checks, strict=True)]
    results = list(zip(names, checks, strict=True))
    if unique is None:
        counts = df.agg(*failures)
    else:
        per_value = df.groupBy(F.col(unique.column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"), *failures)
        repeated = F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1))
        counts = per_value.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names], repeated.alias("_u"))
        results.append(("_u", unique))
    rows = F.array(*[_result(model, c.label, c.column, F.col(n), c.severity) for n, c in results])
    return counts.select(F.inline(rows))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values of ``column`` that occur more than once (DT2)."""
    return (df.select(column).filter(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def unique_check(df: DataFrame, column: str, model: str, severity: str = "error") -> DataFrame:
    failures = duplicate_values(df, column).agg(F.count(F.lit(1)).alias("_f"))
    return failures.select(F.inline(F.array(_result(model, "unique", column, F.col("_f"), severity))))


def relationships_check(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                        model: str, severity: str = "error") -> DataFrame:
    failures = orphan_keys(child, column, parent, parent_column).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("_f"))
    return failures.select(F.inline(F.array(
        _result(model, f"relationships:{parent_column}", column, F.col("_f"), severity))))


def run_checks(df: DataFrame, checks: Sequence[Check], model: str) -> DataFrame:
    """Every check of one table → one results DataFrame (lazy). The row-level checks and the first
    ``unique`` one share an evaluation; each further ``unique`` or ``relationships`` check has its own."""
    keys = [c for c in checks if c.kind == "unique"]
    parts = [run_row_checks(df, checks, model, keys[0] if keys else None)]
    parts += [unique_check(df, c.column, model, c.severity) for c in keys[1:]]
    parts += [relationships_check(df, c.column, c.parent, c.parent_column, model, c.severity) for c in checks if c.kind == "relationships"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- contracts
def contract_result(df: DataFrame, expected: T.StructType | str, model: str) -> tuple:
    """DT8/UP4: output column names and types against the declared contract, as a result row.
    Compares schemas only; reads no data."""
    if isinstance(expected, str):
        expected = T._parse_datatype_string(expected)  # DDL "a INT, b STRING"
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    missing = [n for n, _ in want if n not in dict(got)]
    extra = [n for n, _ in got if n not in dict(want)]
    wrong = [n for n, t in want if n in dict(got) and dict(got)[n] != t]
    failures = len(missing) + len(extra) + len(wrong)
    return (model, "contract", ",".join(missing + extra + wrong) or None, failures, "error",
            "pass" if failures == 0 else "fail", failures == 0)


def contract_check(df: DataFrame, expected: T.StructType | str, model: str) -> DataFrame:
    return df.sparkSession.createDataFrame([contract_result(df, expected, model)], RESULT_SCHEMA)


# ---------------------------------------------------------------- freshness
def freshness(df: DataFrame, loaded_at: str, now: _dt.datetime | Column | None = None,
              warn_after_hours: float = 24, error_after_hours: float = 48,
              source: str = "source") -> DataFrame:
    """DT10: age of the newest row against ``now`` (injectable for tests)."""
    now_c = (F.current_timestamp().cast("timestamp_ntz") if now is None
             else now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz"))
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age_h = (F.unix_micros(now_c.cast("timestamp"))
             - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3_600_000_000.0)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age_h > error_after_hours, F.lit("error"))
              .when(age_h > warn_after_hours, F.lit("warn")).otherwise(F.lit("pass")))
    return newest.select(F.lit(source).alias("source"), F.col("max_loaded_at"),
                         round_half_away(age_h, 3).alias("age_hours"), status.alias("status"))


# --------------------------------------------------------------- rule audit
def rule_audit(df: DataFrame, filters: Sequence[str]) -> DataFrame:
    """QG3: per quality filter, rows it rejects (``failing_rows``) and rows
    for which it is the *first* rejecting filter (``first_failing_rows``).

    A row NULL on a predicate counts as failing it. Only the first-failing
    counts are disjoint and sum to the rows dropped by the conjunction; one
    bad value can fail several filters at once (a NULL time fails the
    not-null test and both date bounds). One aggregation pass.
    """
    passes = [F.coalesce(F.expr(f), F.lit(False)) for f in filters]
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, p in enumerate(passes):
        earlier_ok = F.lit(True)
        for q in passes[:i]:
            earlier_ok = earlier_ok & q
        aggs.append(F.count_if(~p).alias(f"_fail{i}"))
        aggs.append(F.count_if(earlier_ok & ~p).alias(f"_first{i}"))
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f).alias("rule"),
                              F.col(f"_fail{i}").cast("bigint").alias("failing_rows"),
                              F.col(f"_first{i}").cast("bigint").alias("first_failing_rows"),
                              F.col("_total").cast("bigint").alias("total_rows"))
                     for i, f in enumerate(filters)])
    return counts.select(F.inline(rows))


# ------------------------------------------------------ derived range checks
@dataclass(frozen=True)
class Interval:
    """Numbers between two optional bounds; ``lo`` and ``hi`` are (value, strict)."""

    lo: tuple[float, bool] | None = None
    hi: tuple[float, bool] | None = None

    def __and__(self, other: Interval) -> Interval:
        # of two lower bounds the later one holds, at equal values the strict one; upper bounds mirror that
        lows = [b for b in (self.lo, other.lo) if b]
        highs = [b for b in (self.hi, other.hi) if b]
        return Interval(max(lows, default=None), min(highs, key=lambda b: (b[0], not b[1]), default=None))

    @property
    def closed(self) -> bool:
        return not any(b and b[1] for b in (self.lo, self.hi))


_COMPARISON = re.compile(r"\s*(?P<left>\w+)\s*(?P<sign>[<>])(?P<equal>=?)\s*(?P<right>[-+]?[0-9]+(?:\.[0-9]+)?)\s*")


def comparison(predicate: str) -> tuple[str, Interval] | None:
    """``column`` and the interval that ``column <op> number`` allows; None for other predicates."""
    m = _COMPARISON.fullmatch(predicate)
    if m is None or m["left"][0].isdigit():
        return None
    number = float(m["right"])
    bound = (int(number) if number.is_integer() and "." not in m["right"] else number, not m["equal"])
    return m["left"], Interval(lo=bound) if m["sign"] == ">" else Interval(hi=bound)


def derived_range_checks(manifest: Manifest, severity: str = "warn") -> list[Check]:
    """QG4: the intervals that the quality filters allow for numeric Silver columns, as range
    checks in column order. A column's filters intersect; a check is inclusive only if both bounds are."""
    silver_types = {f.name: f.dataType for f in manifest.silver_schema().fields}
    allowed: dict[str, Interval] = {}
    for column, interval in filter(None, map(comparison, manifest.quality_filters)):
        name = manifest.silver_names.get(column)
        if name and isinstance(silver_types[name], T.NumericType):
            allowed[name] = allowed.get(name, Interval()) & interval
    return [accepted_range(name, box.lo and box.lo[0], box.hi and box.hi[0], inclusive=box.closed, severity=severity)
            for name, box in sorted(allowed.items())]


def fact_checks() -> list[Check]:
    """The test set of the trip fact."""
    return [
        not_null("trip_id"),
        unique("trip_id"),
        accepted_values("payment_type_id", [1, 2, 3, 4, 5, 6], severity="warn"),
        accepted_range("trip_duration_minutes", 1, 720),
        positive_value("fare_amount"),
        expression("fare_not_exceeds_total", "total_amount > 0 AND fare_amount > total_amount + 0.01"),
        expression("trip_duration_positive", "trip_duration_minutes < 0"),
        not_null("pickup_zone", severity="warn"),
    ]


def staging_checks(manifest: Manifest) -> list[Check]:
    """DT11: the generic staging test set of a dataset — key not NULL and
    unique, event time and partition date not NULL, derived ranges (warn)."""
    key = manifest.resolved_surrogate_key_name
    return ([not_null(key), unique(key), not_null(manifest.event_ts_silver_col),
             not_null(manifest.partition_date_col)] + derived_range_checks(manifest))
