import datetime as dt

from pyspark.sql import functions as F

from stratum import functions as sf


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_minute_boundaries(spark):
    a = F.lit(dt.datetime(2024, 1, 1, 0, 0, 59)).cast("timestamp_ntz")
    b = F.lit(dt.datetime(2024, 1, 1, 0, 2, 58)).cast("timestamp_ntz")
    assert _one(spark, sf.minute_diff(a, b)) == 2


def test_round_half_away_binary(spark):
    assert _one(spark, sf.round_half_away(F.lit(1.005), 2)) == 1.0
    assert _one(spark, sf.round_half_away(F.lit(0.125), 2)) == 0.13
    assert _one(spark, sf.round_half_away(F.lit(-2.5), 0)) == -3.0


def test_names_and_weekdays(spark):
    d = F.lit(dt.date(2024, 1, 7))  # a Sunday
    assert _one(spark, sf.weekday_name(d)) == "Sunday"
    assert _one(spark, sf.month_name(d)) == "January"
    assert _one(spark, sf.dow_sunday0(d)) == 0
    assert _one(spark, sf.is_weekend(d)) is True


def test_canon_and_hash(spark):
    from pyspark.sql import types as T

    assert _one(spark, sf.canon(F.lit(1e10), T.DoubleType())) == "10000000000.0"
    ts = F.lit(dt.datetime(2024, 1, 1, 10, 0, 7, 123456)).cast("timestamp_ntz")
    assert _one(spark, sf.canon(ts, T.TimestampNTZType())) == "2024-01-01 10:00:07.123456"
    with_null = sf.hash_key([(F.lit(None).cast("int"), T.IntegerType()), (F.lit(1), T.IntegerType())])
    shifted = sf.hash_key([(F.lit(1), T.IntegerType()), (F.lit(None).cast("int"), T.IntegerType())])
    assert _one(spark, with_null) != _one(spark, shifted)  # NULLs keep their slot


def test_avg_stable_is_order_independent(spark):
    vals = [0.1] * 7 + [0.355] * 3
    df1 = spark.createDataFrame([(v,) for v in vals], "x double").repartition(1)
    df2 = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(3)
    a = df1.agg(sf.avg_stable("x")).first()[0]
    b = df2.agg(sf.avg_stable("x")).first()[0]
    assert a == b


def test_key_text_tells_doubles_apart(spark):
    import itertools
    import math

    near = [1.0, math.nextafter(1.0, 2), 0.1, 0.1 + 2 ** -56, 12.344, math.nextafter(12.344, 13), 1e-12, 2e-12, 1e300, math.nextafter(1e300, 1e301),
            -3.25, 3.25, 0.0, 2.0 ** -9, math.nextafter(2.0 ** -9, 0), 2.0 ** 53, 2.0 ** 53 - 1, float("inf"), float("-inf"), float("nan")]
    rows = spark.createDataFrame([(x,) for x in [*near, -0.0]], "x double").select("x", sf.double_text("x").alias("t")).collect()
    texts = [r.t for r in rows]
    assert texts[-1] == texts[near.index(0.0)]  # both zeros group together
    assert all(a != b for a, b in itertools.combinations(texts[:-1], 2))


def test_avg_stable_keeps_what_is_not_finite(spark):
    import math

    avg = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(sf.avg_stable("x")).first()[0]
    assert math.isnan(avg(float("nan"), 1.0)) and math.isinf(avg(float("inf"), 1.0))
    assert avg(1e20, 3e20) == 2e20 and avg(None, 0.0000004, 0.0000002) == 3e-7 and avg(None) is None
