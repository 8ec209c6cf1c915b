from __future__ import annotations

import math
import random

import pytest

from tripweave.operators.latency import latency_stats, slowest, tail_class
from tripweave.operators.profile import RAW_NUMBERS, numeric_profile, preview, year_range
from tripweave.operators import ranks
from tripweave.operators.ranks import discrete_index, floor_index, order_statistics

from conftest import plan_text

# Twelve recorded query times, in seconds.
RECORDED = [13.51, 35.39, 95.97, 17.05, 49.78, 53.52, 69.20, 60.27, 20.99, 32.62, 70.42, 67.78]
SAMPLE = "name string, g string, value double"
PICKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def samples(spark, values, group="all"):
    return spark.createDataFrame([(f"q{i:05d}", group, v) for i, v in enumerate(values)], SAMPLE)


def test_recorded_times(spark):
    times = samples(spark, RECORDED)
    row = tail_class(latency_stats(times)).first()
    assert (row["samples"], row["min_value"], row["max_value"]) == (12, 13.51, 95.97)
    assert (row["p50"], row["p95"], row["p99"]) == (53.52, 95.97, 95.97)
    assert round(row["mean_value"], 2) == 48.88 and round(row["tail_ratio"], 2) == 1.79
    assert row["tail_class"] == "good"
    assert [r["name"] for r in slowest(times).collect()] == ["q00002", "q00010", "q00006"]


@pytest.mark.parametrize("n", [1, 2, 10, 12, 100, 101])
def test_floor_index_rule(spark, n):
    values = [random.Random(n).random() for _ in range(n)]
    row = latency_stats(samples(spark, values)).first()
    for name, p in PICKS.items():
        assert row[name] == sorted(values)[int(n * p)]


def test_no_samples(spark):
    row = tail_class(latency_stats(samples(spark, [1.0]).filter("false"))).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "good")
    assert latency_stats(samples(spark, [1.0]).filter("false"), by=["g"]).count() == 0


@pytest.mark.parametrize(
    ("p50", "p99", "label"), [(1.0, 3.01, "high"), (1.0, 3.0, "moderate"), (1.0, 2.0, "good"), (0.0, 9.0, "good")]
)
def test_tail_classes(spark, p50, p99, label):
    assert tail_class(spark.createDataFrame([(p50, p99)], "p50 double, p99 double")).first()["tail_class"] == label


def test_null_groups_and_null_values(spark):
    rows = [("a", None, 1.0), ("b", None, 3.0), ("c", "x", 5.0), ("d", "x", None)]
    stats = latency_stats(spark.createDataFrame(rows, SAMPLE), by=["g"]).collect()
    assert {r["g"]: (r["samples"], r["p50"]) for r in stats} == {None: (2, 3.0), "x": (1, 5.0)}


def shapes():
    rng = random.Random(3)
    skewed = [math.exp(rng.gauss(0, 4)) for _ in range(3000)]
    return {
        "uniform": [rng.random() for _ in range(3000)],
        "skewed": skewed,
        "one outlier": [*skewed, 1e300, -1e300],
        "copies": [7.0] * 2500 + [rng.random() for _ in range(500)],
        "all equal": [2.0] * 3000,
        "two values": [1.0] * 1500 + [1.0000000000000002] * 1500,
        "special": [*skewed, *[math.inf] * 40, *[-math.inf] * 40, *[math.nan] * 40],
        "tiny": [5e-324 * rng.randrange(4) for _ in range(3000)],
        "huge span": [rng.choice([-1, 1]) * 1.7e308 * rng.random() for _ in range(3000)],
        "only infinite": [math.inf] * 1500 + [-math.inf] * 1500,
    }


@pytest.mark.parametrize("shape", list(shapes()))
def test_narrowing_finds_the_same_ranks(spark, shape):
    values = shapes()[shape]
    frame = samples(spark, values, "hot").unionByName(samples(spark, [3.0, 1.0, 2.0], "small"))
    picks = {"first": lambda n: n * 0, "last": lambda n: n - 1, **{k: floor_index(p) for k, p in PICKS.items()}}
    ranked = order_statistics(frame, "value", picks, ["g"], direct_limit=100, bins=64)
    got = {(r["key"]["g"], r["pick"]): r["value"] for r in ranked.collect()}
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    n = len(values)
    index = {"first": 0, "last": n - 1, **{k: int(n * p) for k, p in PICKS.items()}}
    for name, i in index.items():
        assert got["hot", name] == ordered[i] or (math.isnan(got["hot", name]) and math.isnan(ordered[i])), name
    assert got["small", "p50"] == 2.0 and len(got) == 10


def test_discrete_index(spark):
    values = [float(v) for v in range(1, 11)]
    got = order_statistics(samples(spark, values), "value", {"q": discrete_index(0.25), "zero": discrete_index(0.0)})
    assert {r["pick"]: r["value"] for r in got.collect()} == {"q": 3.0, "zero": 1.0}


def test_slowest_limits_before_the_shuffle(spark):
    frame = samples(spark, [1.0, 5.0, 5.0, 2.0], "a").unionByName(samples(spark, [9.0], "b"))
    top = slowest(frame, 2, by=["g"])
    got = sorted((r["g"], r["position"], r["name"]) for r in top.collect())
    assert got == [("a", 1, "q00001"), ("a", 2, "q00002"), ("b", 1, "q00000")]
    assert plan_text(top).count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in plan_text(slowest(frame, 2))


def test_profile(spark, clean_table):
    approximate = {r["summary"]: r for r in numeric_profile(clean_table).collect()}
    exact = {r["summary"]: r for r in numeric_profile(clean_table, exact=True).collect()}
    assert list(approximate) == list(exact) == ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    shown = {r["summary"]: r for r in clean_table.select("total_amount", "passenger_count").summary().collect()}
    for name in exact:
        assert approximate[name] == exact[name]
        assert exact[name]["total_amount"] == pytest.approx(float(shown[name]["total_amount"]))
        assert exact[name]["passenger_count"] == pytest.approx(float(shown[name]["passenger_count"]))


def test_profile_counts_nulls_out(make_trips):
    trips = make_trips({"airport_fee": None}, {"airport_fee": 1.25}, {})
    rows = {r["summary"]: r["airport_fee"] for r in numeric_profile(trips, RAW_NUMBERS, exact=True).collect()}
    assert rows["count"] == 2 and rows["min"] == 0.0 and rows["max"] == 1.25


def test_year_range_and_preview(make_trips):
    early = {"pickup": "2001-01-01 00:00:00", "dropoff": "1900-01-01 00:00:00"}
    trips = make_trips(early, {"dropoff": "2253-01-01 00:00:00"})
    assert tuple(year_range(trips).first()) == (2001, 2019, 1900, 2253)
    assert [r["pickup_datetime"].year for r in preview(trips, 1).collect()] == [2001]


def test_spans_beyond_a_broadcast_give_the_same_ranks(spark, monkeypatch):
    values = shapes()["skewed"]
    monkeypatch.setattr(ranks, "BROADCAST_BYTES", 0)
    row = latency_stats(samples(spark, values), direct_limit=100).first()
    for name, p in PICKS.items():
        assert row[name] == sorted(values)[int(len(values) * p)]


@pytest.mark.parametrize("shape", list(shapes()))
def test_brackets_hold_the_same_ranks(spark, shape):
    """Groups large enough that sketches of 16 values bracket them, against sorting."""
    values = shapes()[shape]
    picks = {f"p{p}": floor_index(p) for p in (0.0, 0.01, 0.3, 0.5, 0.95, 0.99, 1.0)}
    rows = samples(spark, values).unionByName(samples(spark, values[::2] + [None], "half")).unionByName(samples(spark, [None], "none"))
    order = {"all": sorted(values, key=lambda v: (math.isnan(v), v)), "half": sorted(values[::2], key=lambda v: (math.isnan(v), v))}
    got = {r["key"]["g"]: r["value"] for r in ranks.bracketed(rows, ["value"], picks, ["g"], k=64).collect()}
    assert got["none"]["size"] == 0 and got["none"]["p0.5"] is None
    for group, own in order.items():
        assert got[group]["size"] == len(own)
        for p in (0.0, 0.01, 0.3, 0.5, 0.95, 0.99, 1.0):
            expected = own[min(int(len(own) * p), len(own) - 1)]
            assert got[group][f"p{p}"] == expected or (math.isnan(expected) and math.isnan(got[group][f"p{p}"]))


def test_brackets_of_several_columns(spark):
    rng = random.Random(9)
    rows = [(rng.random(), float(rng.randrange(3)), None if i % 3 else rng.gauss(0, 1), None) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    picks = {"25%": discrete_index(0.25), "50%": discrete_index(0.5)}
    (got,) = ranks.bracketed(frame, ["a", "b", "c", "d"], picks, k=200).collect()
    for i, column in enumerate("abc"):
        own = sorted(r[i] for r in rows if r[i] is not None)
        for p in (0.25, 0.5):
            assert got[column][f"{p:.0%}"] == own[max(math.ceil(len(own) * p) - 1, 0)]
    assert got["d"]["50%"] is None and got["d"]["size"] == 0
    assert ranks.bracketed(frame.limit(0), ["a"], picks).count() == 0


def test_plans_are_built_without_a_job(spark):
    spark.range(5000).selectExpr("cast(id AS double) value", "'x' g").createOrReplaceTempView("plan_samples")
    frame = spark.table("plan_samples")
    spark.sparkContext.setJobGroup("building", "none expected")
    try:
        latency_stats(frame, by=["g"])
        numeric_profile(frame, ["value"], exact=True)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
        assert latency_stats(frame, by=["g"]).first()["p50"] == 2500.0
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
