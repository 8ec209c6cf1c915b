from __future__ import annotations

import pytest

from tripweave import fixtures
from tripweave.operators import zones as lookup
from tripweave.plans.etl import clean_trips, clean_trips_basic
from tripweave.schemas import CLEAN_SCHEMA, ZONE_SCHEMA

from conftest import TINY, plan_text


def test_both_roles(make_trips, zones):
    got = lookup.with_zones(make_trips({"PULocationID": 7, "DOLocationID": 1}), zones, details=True).first()
    columns = [f"{role}_{part}" for role in ("pickup", "dropoff") for part in ("borough", "zone", "service_zone")]
    assert [got[c] for c in columns] == ["Queens", "Astoria", "Boro Zone", "EWR", "Newark Airport", "EWR"]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge"])
def test_unknown_and_missing_zones_drop_the_trip(make_trips, zones, strategy):
    ends = [(4, 7), (264, 7), (4, 265), (266, 4), (None, 4), (4, None), (999, 4)]
    trips = make_trips(*[{"PULocationID": a, "DOLocationID": b} for a, b in ends])
    assert lookup.with_zones(trips, zones, strategy=strategy).count() == 1
    assert lookup.with_zones(trips, zones, exclude=(), strategy=strategy).count() == 4


def test_duplicate_ids_are_refused(spark, make_trips, zones):
    twice = zones.union(spark.createDataFrame([(4, "Bronx", "x", "y")], ZONE_SCHEMA))
    with pytest.raises(ValueError, match="not unique"):
        lookup.with_zones(make_trips({}), twice)


def test_broadcast_needs_a_small_table(spark, make_trips, zones, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_MAX_ROWS", 3)
    with pytest.raises(ValueError, match="too large"):
        lookup.with_zones(make_trips({}), zones, strategy="broadcast")
    joined = lookup.with_zones(make_trips({}), zones)
    assert "BroadcastHashJoin" not in plan_text(joined) and joined.count() == 1


def test_strategies_agree(spark):
    trips, zones = fixtures.order_trips(spark, TINY), fixtures.nation_zones(spark, TINY)
    broadcast = lookup.with_zones(trips, zones, strategy="broadcast", details=True)
    merged = lookup.with_zones(trips, zones, strategy="merge", details=True)
    assert merged.columns == broadcast.columns
    assert merged.exceptAll(broadcast).count() == 0 and merged.count() == broadcast.count()


def test_join_plans(spark, make_trips, zones):
    trips = make_trips({})
    broadcast = plan_text(lookup.with_zones(trips, zones))
    assert broadcast.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in broadcast
    merged = plan_text(lookup.with_zones(trips, zones, strategy="merge"))
    assert merged.count("SortMergeJoin") >= 2 and "BroadcastHashJoin" not in merged


def test_a_hot_zone_spreads_over_tasks(spark, make_trips, zones):
    from pyspark.sql import functions as F

    amounts = F.explode(F.sequence(F.lit(1), F.lit(1000)).cast("array<double>"))
    trips = make_trips({}).withColumn("total_amount", amounts)
    salted = lookup.with_zones(trips, zones, strategy="merge", salts=16)
    assert salted.count() == 1000
    salt = F.pmod(F.xxhash64(*lookup._salt_columns(trips)), F.lit(16))
    sizes = [r["count"] for r in trips.groupBy(salt).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 150


def test_only_measured_hot_zones_are_cut(spark, make_trips, zones):
    from pyspark.sql import functions as F

    once = make_trips({"PULocationID": 7, "DOLocationID": 1}, {"PULocationID": None})
    amounts = F.explode(F.sequence(F.lit(1), F.lit(1000)).cast("array<double>"))
    trips = once.unionByName(make_trips({"DOLocationID": 4}).withColumn("total_amount", amounts))
    assert lookup.hot_zones(trips) == {"pickup": {4: 8}, "dropoff": {4: 8}}
    assert lookup.hot_zones(trips.limit(0)) == {"pickup": {}, "dropoff": {}}
    for salts in (None, 3, lookup.hot_zones(trips)):
        merged = lookup.with_zones(trips, zones, strategy="merge", salts=salts)
        assert merged.exceptAll(lookup.with_zones(trips, zones)).count() == 0 and merged.count() == 1001


def test_a_merge_join_reads_the_trips_once(spark, make_trips, zones, tmp_path):
    make_trips({}, {}).write.parquet(str(tmp_path / "trips"))
    trips, facts = spark.read.parquet(str(tmp_path / "trips")), lookup.measure_zones(zones)
    spark.sparkContext.setJobGroup("joining", "none expected")
    try:
        merged = lookup.with_zones(trips, zones, strategy="merge", facts=facts)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("joining")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    physical = merged._jdf.queryExecution().executedPlan().toString()
    assert physical.count("FileScan parquet") == 1 and physical.count("SortMergeJoin") == 2


def test_clean_jobs(make_trips, zones):
    trips = make_trips({}, {"passenger_count": None}, {"trip_distance": 5000.0}, {"trip_distance": -1.0})
    strict = clean_trips(trips, zones)
    assert strict.columns == CLEAN_SCHEMA.names and strict.count() == 2
    basic = clean_trips_basic(trips, zones)
    assert basic.columns == [
        "tpep_pickup_datetime",
        "trip_duration_mins",
        "trip_distance",
        "total_amount",
        "passenger_count",
        "airport_fee",
        "pickup_borough",
        "dropoff_borough",
    ]
    assert sorted(r["trip_distance"] for r in basic.collect()) == [3.0, 5000.0]


def test_unknown_strategy(make_trips, zones):
    with pytest.raises(ValueError):
        lookup.with_zones(make_trips({}), zones, strategy="nested")
