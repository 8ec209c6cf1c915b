from __future__ import annotations

import pytest

from tripweave import fixtures
from tripweave.operators.quality import (
    BASIC_RULES,
    STRICT_RULES,
    apply_rules,
    attrition,
    clean,
    fill_defaults,
    with_duration,
)

from conftest import TINY

KEPT = [
    {"trip_distance": 0.01},
    {"trip_distance": 3000.0},
    {"total_amount": 0.01},
    {"total_amount": 2000.0},
    {"dropoff": "2019-06-05 10:01:00.600000"},  # 1.01 minutes
    {"dropoff": "2019-06-05 13:59:59.400000"},  # 239.99 minutes
    {"passenger_count": None},
    {"passenger_count": 5},
    {"airport_fee": None},
    {"pickup": "2011-01-01 00:00:00", "dropoff": "2011-01-01 00:10:00"},
    {"pickup": "2024-12-31 23:00:00", "dropoff": "2024-12-31 23:59:59"},
]
DROPPED = [
    {"trip_distance": 0.0},
    {"trip_distance": 3000.01},
    {"trip_distance": None},
    {"total_amount": 0.0},
    {"total_amount": 2000.01},
    {"total_amount": None},
    {"dropoff": "2019-06-05 10:01:00"},  # exactly 1 minute
    {"dropoff": "2019-06-05 10:01:00.200000"},  # rounds to 1.00
    {"dropoff": "2019-06-05 14:00:00"},  # exactly 240 minutes
    {"dropoff": "2019-06-05 13:59:59.700000"},  # rounds to 240.00
    {"dropoff": "2019-06-05 09:00:00"},
    {"dropoff": None},
    {"pickup": None},
    {"passenger_count": 0},
    {"passenger_count": 6},
    {"PULocationID": None},
    {"DOLocationID": None},
    {"pickup": "2010-12-31 23:59:00", "dropoff": "2011-01-01 00:10:00"},
    {"pickup": "2024-12-31 23:50:00", "dropoff": "2025-01-01 00:10:00"},
]


@pytest.mark.parametrize("trip", KEPT, ids=str)
def test_strict_keeps(make_trips, trip):
    assert clean(make_trips(trip)).count() == 1


@pytest.mark.parametrize("trip", DROPPED, ids=str)
def test_strict_drops(make_trips, trip):
    assert clean(make_trips(trip)).count() == 0


def test_fill(make_trips):
    row = fill_defaults(make_trips({"passenger_count": None, "airport_fee": None, "trip_distance": None})).first()
    assert (row["passenger_count"], row["airport_fee"], row["trip_distance"]) == (1, 0.0, None)


def test_filling_first_keeps_unknown_passengers(make_trips):
    trips = make_trips({"passenger_count": None}, {"passenger_count": 2}, {"passenger_count": 0})
    assert clean(trips, BASIC_RULES).count() == 2
    assert clean(trips, BASIC_RULES, fill_first=False).count() == 1


def test_cleaning_is_idempotent_and_strict_is_narrower(spark):
    trips = fixtures.order_trips(spark, TINY)
    once = clean(trips)
    again = clean(once.drop("trip_duration_mins"))
    assert once.exceptAll(again).count() == 0 and again.count() == once.count()
    assert once.exceptAll(clean(trips, BASIC_RULES)).count() == 0


def test_attrition_adds_up(make_trips):
    trips = with_duration(fill_defaults(make_trips(*KEPT, *DROPPED)))
    report = attrition(trips).orderBy("step").collect()
    assert [r["rule"] for r in report] == [rule.name for rule in STRICT_RULES]
    assert report[0]["rows_before"] == len(KEPT) + len(DROPPED)
    assert report[-1]["rows_after"] == len(KEPT) == apply_rules(trips, STRICT_RULES).count()
    assert all(a["rows_after"] == b["rows_before"] for a, b in zip(report, report[1:]))
    for row, rule in zip(report, STRICT_RULES):
        assert row["failing_alone"] == trips.filter(~rule.holds()).count()
    assert report[-1]["removed_pct"] == 100.0 * len(DROPPED) / (len(KEPT) + len(DROPPED))


def test_attrition_of_nothing(make_trips):
    empty = with_duration(make_trips({})).filter("false")
    report = attrition(empty, BASIC_RULES).collect()
    assert [(r["rows_after"], r["removed_pct"]) for r in report] == [(0, None)] * len(BASIC_RULES)
