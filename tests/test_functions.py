from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tripweave.functions import labels, ratios
from tripweave.functions.temporal import in_years, minutes_between

NTZ = "cast({} as timestamp_ntz)"


def minutes(spark, pairs, **options):
    frame = spark.createDataFrame(pairs, "i int, a string, b string").selectExpr(
        "i", f"{NTZ.format('a')} a", f"{NTZ.format('b')} b"
    )
    got = frame.select("i", minutes_between(F.col("a"), F.col("b"), **options).alias("m")).orderBy("i")
    return [row["m"] for row in got.collect()]


def test_known_durations(spark):
    pairs = [
        (0, "2011-01-01 00:58:10", "2011-01-01 01:15:35"),
        (1, "2011-01-01 00:23:27", "2011-01-01 00:39:39"),
        (2, "2011-01-01 00:37:47", "2011-01-01 00:41:20"),
        (3, "2011-01-01 00:00:10", "2011-01-01 00:00:00"),
        (4, None, "2011-01-01 00:00:00"),
    ]
    assert minutes(spark, pairs) == [17.42, 16.2, 3.55, -0.17, None]


def test_duration_rounds_half_up_at_every_digit(spark):
    rng = random.Random(7)
    start = datetime(2015, 3, 1)
    pairs, exact = [], []
    for i in range(400):
        # Half of the gaps are exact ties of the second digit.
        micros = 600_000 * rng.randrange(-9000, 90_000) + (300_000 if i % 2 else rng.randrange(600_000))
        pairs.append((i, start.isoformat(" "), (start + timedelta(microseconds=micros)).isoformat(" ")))
        exact.append(Decimal(micros) / 60_000_000)
    for digits in (0, 2, 4):
        step = Decimal(1).scaleb(-digits)
        expected = [float(x.quantize(step, ROUND_HALF_UP)) for x in exact]
        assert minutes(spark, pairs, digits=digits) == expected


def test_duration_across_a_clock_change(spark):
    gap = [(0, "2024-03-10 01:30:00", "2024-03-10 03:30:00")]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert minutes(spark, gap) == [120.0]
            assert minutes(spark, gap, zone="America/New_York") == [60.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_year_range_edges(spark):
    rows = ["2010-12-31 23:59:59.999999", "2011-01-01 00:00:00", "2024-12-31 23:59:59.999999", "2025-01-01 00:00:00"]
    frame = spark.createDataFrame([(r,) for r in rows], "t string").selectExpr("cast(t as timestamp_ntz) t")
    assert [r[0] for r in frame.select(in_years(F.col("t"), 2011, 2024)).collect()] == [False, True, True, False]


def evaluate(spark, build, values, dtype):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in frame.orderBy("i").select(build(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("build", "values", "dtype", "expected"),
    [
        (labels.day_name, [1, 7, 0, 8, -1, None], "int", ["Sunday", "Saturday"] + ["Unknown"] * 4),
        (labels.month_name, [1, 12, 13, None], "int", ["Jan", "Dec", "Unknown", "Unknown"]),
        (labels.is_weekend, [1, 2, 6, 7, None], "int", ["Weekend", "Weekday", "Weekday", "Weekend", "Weekday"]),
        (
            labels.hour_label,
            [0, 1, 11, 12, 13, 23, None],
            "int",
            ["12 AM", "1 AM", "11 AM", "12 PM", "1 PM", "11 PM", None],
        ),
        (
            labels.trip_category,
            [2.0, 2.01, 5.0, 5.01, 10.0, 10.01, None],
            "double",
            [
                "Very Short (<2mi)",
                "Short (2-5mi)",
                "Short (2-5mi)",
                "Medium (5-10mi)",
                "Medium (5-10mi)",
                "Long Haul (>10mi)",
                "Very Short (<2mi)",
            ],
        ),
        (
            labels.magnitude_label,
            [0.0, 999.0, 1000.0, 34499.0, 999999.0, 1e6, 1234567.0, 1343849675.0],
            "double",
            ["0", "999", "1K", "34K", "1000K", "1.0M", "1.2M", "1343.8M"],
        ),
        (labels.number_text, [1239772523.0, 0.5], "double", ["1,239,772,523.00", "0.50"]),
    ],
)
def test_labels(spark, build, values, dtype, expected):
    assert evaluate(spark, build, values, dtype) == expected


def test_route_label(spark):
    row = spark.range(1).select(
        labels.route_label(F.lit("Queens"), F.lit("EWR")).alias("a"),
        labels.route_label(F.lit("Queens"), F.lit(None).cast("string")).alias("b"),
    )
    assert tuple(row.first()) == ("Queens → EWR", None)


def test_ratios_guard_their_divisors(spark):
    frame = spark.createDataFrame([(10.0, 30.0), (10.0, 0.0), (10.0, -5.0), (None, 30.0)], "d double, m double")
    assert [r[0] for r in frame.select(ratios.speed_mph(F.col("d"), F.col("m"))).collect()] == [20.0, None, None, None]
    frame = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None)], "a double, d double")
    assert [r[0] for r in frame.select(ratios.fare_per_mile(F.col("a"), F.col("d"))).collect()] == [2.5, None, None]
