"""Certification fixtures for the trip manifest (own generator, fixed seed).

* clean: N valid rows;
* edge: 50 valid rows + one violation per quality filter + 20 exact
  duplicates of valid rows.

Violation rule per filter kind: ``IS NOT NULL`` → NULL; ``> n`` → n;
``>= n`` → n − 1; ``>= DATE d`` → the day before d; ``< DATE d`` → d.
"""

from __future__ import annotations

import datetime as dt
import random
import re

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("VendorID", T.LongType()), T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()), T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()), T.StructField("RatecodeID", T.LongType()),
    T.StructField("store_and_fwd_flag", T.StringType()), T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()), T.StructField("payment_type", T.LongType()),
    *[T.StructField(n, T.DoubleType()) for n in (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
        "total_amount", "congestion_surcharge", "Airport_fee")],
])


def valid_row(rng: random.Random) -> dict:
    pickup = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(0, 30 * 86400))
    fare = round(rng.uniform(5, 50), 2)
    return {
        "VendorID": rng.choice([1, 2]), "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": pickup + dt.timedelta(minutes=rng.randint(3, 60)),
        "passenger_count": rng.randint(1, 4), "trip_distance": round(rng.uniform(0.5, 15), 2),
        "RatecodeID": rng.choice([1, 2, 3]), "store_and_fwd_flag": rng.choice(["N", "Y"]),
        "PULocationID": rng.randint(1, 265), "DOLocationID": rng.randint(1, 265),
        "payment_type": rng.choice([1, 2]), "fare_amount": fare, "extra": rng.choice([0.0, 0.5, 1.0]),
        "mta_tax": 0.5, "tip_amount": round(rng.uniform(0, 10), 2), "tolls_amount": 0.0,
        "improvement_surcharge": 0.3, "total_amount": round(fare + rng.uniform(2, 20), 2),
        "congestion_surcharge": rng.choice([0.0, 2.5]), "Airport_fee": rng.choice([0.0, 1.25]),
    }


def violate(row: dict, rule: str) -> dict:
    row = dict(row)
    m = re.match(r"^\s*(?:CAST\()?(\w+)(?: AS DATE\))?\s*(IS NOT NULL|>=|>|<)\s*(?:DATE\s*'([\d-]+)'|(-?[\d.]+))?", rule)
    col, op, day, num = m.groups()
    if op == "IS NOT NULL":
        row[col] = None
    elif day:
        d = dt.date.fromisoformat(day)
        d = d - dt.timedelta(days=1) if op == ">=" else d
        t = dt.datetime.combine(d, dt.time(12))
        row[col] = t
        if col == "tpep_pickup_datetime":
            row["tpep_dropoff_datetime"] = t + dt.timedelta(minutes=10)
    else:
        n = float(num)
        row[col] = n if op == ">" else n - 1
        if isinstance(row[col], float) and RAW_SCHEMA[col].dataType == T.LongType():
            row[col] = int(row[col])
    return row


def clean_set(n: int = 1000, seed: int = 42) -> list[dict]:
    rng = random.Random(seed)
    return [valid_row(rng) for _ in range(n)]


def edge_set(filters, seed: int = 43) -> tuple[list[dict], dict]:
    rng = random.Random(seed)
    valid = [valid_row(rng) for _ in range(50)]
    bad = [violate(valid_row(rng), f) for f in filters]
    dupes = [dict(valid[i % len(valid)]) for i in range(20)]
    expected = {"bronze": 50 + len(bad) + 20, "silver": 50, "filtered": len(bad), "deduplicated": 20}
    return valid + bad + dupes, expected
