"""Column helpers (FN1–FN14). Every helper returns a JVM-side ``Column``;
nothing here runs Python per row.

Several helpers exist only to pin down semantics that differ between SQL
engines (minute differences, rounding of doubles, weekday names, averages of
decimals); each says which behaviour it implements.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- durations
def minute_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed between two timestamps (BIGINT).

    00:00:59 → 00:02:58 is 2, not 1: both ends are truncated to the minute
    first, which is how the mart layer counts trip minutes.
    """
    return F.timestamp_diff("MINUTE", F.date_trunc("MINUTE", _c(start)),
                            F.date_trunc("MINUTE", _c(end))).cast("bigint")


# ----------------------------------------------------------------- rounding
def round_half_away(x: ColumnOrName, digits: int = 2) -> Column:
    """Round a DOUBLE to ``digits`` places as ``round(x·10^d) / 10^d`` with
    halves away from zero, evaluated on the binary value (so 1.005 → 1.0).

    Spark's own ``round`` on doubles rounds the shortest decimal text of the
    value (1.005 → 1.01); marts are specified with the binary behaviour.
    """
    x = _c(x).cast("double")
    if digits == 0:
        return F.round(x, 0)
    scale = float(10 ** digits)
    return F.round(x * F.lit(scale), 0) / F.lit(scale)


def avg_double(x: ColumnOrName) -> Column:
    """Average of a numeric column as DOUBLE: exact sum, then one division.

    ``avg`` over DECIMAL would otherwise stay DECIMAL(p+4, s+4) in Spark.
    """
    x = _c(x)
    return F.sum(x).cast("double") / F.count(x)


def avg_stable(x: ColumnOrName, scale: int = 15) -> Column:
    """Average of a DOUBLE column from an exact DECIMAL(38, scale) sum.

    A plain double sum depends on the order rows meet in the partial
    aggregates, so a mean that sits on a rounding boundary (``x.xx5``) can
    round either way from one run to the next. Summing exactly first makes
    the result independent of partitioning. Columns with NaN, infinite or
    very large values (1e12 and more) have the plain average, which keeps them.
    """
    x = _c(x).cast("double")
    plain = F.abs(x) < F.lit(1e12)  # false for NaN, which compares as the largest value
    exact = F.sum(F.when(plain, x).cast(T.DecimalType(38, scale))).cast("double")
    return F.when(F.count_if(x.isNotNull() & ~plain) > 0, F.avg(x)).otherwise(
        F.try_divide(exact, F.count(x).cast("double")))


def sum_decimal(x: ColumnOrName, precision: int = 38, scale: int = 2) -> Column:
    """Exact sum of a DECIMAL column widened to DECIMAL(38, s)."""
    return F.sum(_c(x)).cast(T.DecimalType(precision, scale))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 2,
               scale: float = 1.0) -> Column:
    """``round(num / den * scale, digits)`` when ``den > 0``, else NULL.
    Both sides are divided as DOUBLE."""
    num_d, den_d = _c(num).cast("double"), _c(den).cast("double")
    value = num_d / den_d
    if scale != 1.0:
        value = value * F.lit(scale)
    return F.when(den_d > 0, round_half_away(value, digits))


# ----------------------------------------------------------------- calendar
def hour_of_day(ts: ColumnOrName) -> Column:
    return F.hour(_c(ts)).cast("bigint")


def weekday_name(d: ColumnOrName) -> Column:
    """Full English weekday name: ``Monday`` … ``Sunday``."""
    return F.date_format(_c(d), "EEEE")


def month_name(d: ColumnOrName) -> Column:
    """Full English month name: ``January`` … ``December``."""
    return F.date_format(_c(d), "MMMM")


def dow_sunday0(d: ColumnOrName) -> Column:
    """Day of week with Sunday = 0 … Saturday = 6 (BIGINT)."""
    return (F.dayofweek(_c(d)) - 1).cast("bigint")


def is_weekend(d: ColumnOrName) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)


def calendar_parts(d: ColumnOrName) -> dict[str, Column]:
    """year, month, day, Sunday-0 weekday and ISO week, all BIGINT."""
    d = _c(d)
    return {
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day_of_month": F.dayofmonth(d).cast("bigint"),
        "day_of_week_num": dow_sunday0(d),
        "week_of_year": F.weekofyear(d).cast("bigint"),
    }


def in_dates(d: ColumnOrName, dates: Iterable[_dt.date | str]) -> Column:
    """Membership of a DATE column in a fixed list of dates (FN11)."""
    values = [F.lit(_dt.date.fromisoformat(x) if isinstance(x, str) else x) for x in dates]
    return F.coalesce(_c(d).isin(*values), F.lit(False))


# --------------------------------------------------------------- canonical text
def double_text(c: ColumnOrName) -> Column:
    """Text that tells any two different doubles apart, in whole numbers that every engine
    prints alike: ``floor.fraction`` with the fraction as a multiple of 2^-62.

    From 2^-9 to 2^53 that is exact; values beyond (and NaN) are ``d`` and the
    engine's own text. Zero has one text whatever its sign, as grouping sees it.
    """
    x = _c(c).cast("double") + F.lit(0.0)
    size = F.abs(x)
    whole = F.floor(x)
    part = ((x - whole) * F.lit(float(1 << 62))).cast("bigint")
    return F.when((x == 0) | ((size >= F.lit(2.0 ** -9)) & (size < F.lit(2.0 ** 53))),
                  F.concat(whole.cast("string"), F.lit("."), part.cast("string"))).otherwise(
        F.concat(F.lit("d"), x.cast("string")))


def canon(c: ColumnOrName, dtype: T.DataType) -> Column:
    """Engine-independent text of a value, used inside hash keys: two values have one
    text only if grouping takes them as equal.

    Integers and strings as is; floating point by ``double_text``; decimals at
    their own scale; timestamps as ``yyyy-MM-dd HH:mm:ss.SSSSSS``; dates ISO;
    booleans ``true``/``false``.
    """
    c = _c(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return double_text(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return c.cast("string")


def hash_key(fields: list[tuple[ColumnOrName, T.DataType]], sep: str = "|") -> Column:
    """``md5(concat_ws(sep, coalesce(canon(f), '') …))``: NULLs keep their slot."""
    parts = [F.coalesce(canon(c, t), F.lit("")) for c, t in fields]
    return F.md5(F.concat_ws(sep, *parts))


def iso_text(ts: ColumnOrName) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` with a fraction only when there is one
    (the form Python's ``isoformat`` gives)."""
    ts = _c(ts)
    frac = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(frac == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), frac))
