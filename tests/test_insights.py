from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tripweave.operators.enrich import enrich
from tripweave.plans import insights, report
from tripweave.plans.etl import clean_trips
from tripweave.plans.rollup import rollup

from conftest import plan_text

COLUMNS = {
    "borough_stats": "pickup_borough trip_count avg_fare avg_distance avg_duration_mins total_revenue avg_passengers",
    "congestion_by_hour": "pickup_hour avg_speed_mph trip_count avg_duration_mins",
    "yearly_trends": "pickup_year trip_count avg_fare avg_distance",
    "trip_categories": "trip_category trip_count avg_cost avg_distance avg_passengers avg_duration_mins",
    "dow_patterns": "day_name trip_count avg_fare avg_speed_mph",
    "top_routes": "pickup_borough dropoff_borough trip_count avg_fare avg_distance",
    "monthly_patterns": "month_name trip_count avg_fare avg_distance avg_speed_mph",
    "airport_trips": "pickup_borough dropoff_borough trip_count avg_fare avg_distance avg_duration_mins "
    "total_airport_fees",
    "passenger_patterns": "passenger_count trip_count avg_fare avg_distance avg_duration_mins",
    "fare_efficiency": "pickup_borough trip_count avg_fare_per_mile avg_fare avg_distance",
    "weekend_comparison": "is_weekend trip_count avg_fare avg_distance avg_speed_mph avg_duration_mins",
    "peak_hours": "pickup_hour trip_count avg_fare avg_speed_mph total_revenue hour_label",
}
BY_NAME = {i.name: i for i in insights.INSIGHTS}
WHOLE = ("borough_stats congestion_by_hour yearly_trends trip_categories dow_patterns monthly_patterns "
         "passenger_patterns fare_efficiency weekend_comparison").split()


@pytest.fixture(scope="module")
def results(clean_table):
    return {i.name: i(clean_table).collect() for i in insights.INSIGHTS}


def test_columns(clean_table):
    assert {i.name: " ".join(i(clean_table).columns) for i in insights.INSIGHTS} == COLUMNS


@pytest.mark.parametrize("name", WHOLE)
def test_counts_add_up_to_the_clean_rows(results, clean_table, name):
    assert sum(r["trip_count"] for r in results[name]) == clean_table.count()


@pytest.mark.parametrize(
    ("name", "column", "sign"),
    [
        ("borough_stats", "avg_fare", -1),
        ("congestion_by_hour", "pickup_hour", 1),
        ("yearly_trends", "pickup_year", 1),
        ("trip_categories", "avg_cost", -1),
        ("top_routes", "trip_count", -1),
        ("airport_trips", "trip_count", -1),
        ("passenger_patterns", "passenger_count", 1),
        ("fare_efficiency", "avg_fare_per_mile", -1),
        ("weekend_comparison", "is_weekend", 1),
        ("peak_hours", "trip_count", -1),
    ],
)
def test_order(results, name, column, sign):
    values = [r[column] for r in results[name]]
    assert values == sorted(values, reverse=sign < 0)


def test_hidden_keys_still_order_the_result(results):
    week = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert [r["day_name"] for r in results["dow_patterns"]] == week
    year = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    assert [r["month_name"] for r in results["monthly_patterns"]] == year


def test_row_limits(results):
    assert len(results["top_routes"]) == 10 and len(results["airport_trips"]) <= 15
    assert len(results["peak_hours"]) == 10


def test_rounding(results, clean_table):
    for row in results["trip_categories"]:
        assert row["avg_passengers"] == round(row["avg_passengers"], 1)
        assert row["avg_cost"] == round(row["avg_cost"], 2)
    exact = insights.borough_stats(clean_table, digits=None).collect()
    assert any(r["avg_fare"] != round(r["avg_fare"], 2) for r in exact)


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9))


@pytest.mark.parametrize("name", list(COLUMNS))
def test_rollup_answers_the_same(clean_table, name):
    insight = BY_NAME[name] if name != "airport_trips" else insights.for_airports(["AFRICA"])
    direct = insight(clean_table, digits=None).collect()
    rolled = insight(rollup(clean_table), digits=None).collect()
    assert len(direct) == len(rolled) > 0
    assert all(same(a, b) for x, y in zip(direct, rolled) for a, b in zip(x, y))


def test_rollup_refuses_measures_it_does_not_hold(clean_table):
    unknown = insights.Insight("x", ("pickup_year",), (insights.peak("total_amount", "p"),))
    with pytest.raises(ValueError, match="total_amount_max"):
        unknown(rollup(clean_table))


def test_borough_summaries_over_the_rollup(clean_table):
    cells = rollup(clean_table)
    for insight in (insights.baseline_borough, insights.borough_counts, insights.borough_means):
        direct, rolled = insight(clean_table).collect(), insight(cells).collect()
        assert all(same(a, b) for x, y in zip(direct, rolled, strict=True) for a, b in zip(x, y))


def test_rollup_keeps_null_and_guarded_rows_apart(spark, make_trips, zones):
    """Rows a cleaned table never holds must still count the same both ways."""
    trips = clean_trips(make_trips({}, {"total_amount": 30.0}), zones)
    odd = trips.withColumns(
        {
            "trip_distance": F.when(F.col("total_amount") == 30.0, F.lit(-1.0)).otherwise(F.col("trip_distance")),
            "trip_duration_mins": F.when(F.col("total_amount") == 30.0, F.lit(0.0)).otherwise(F.lit(30.0)),
            "passenger_count": F.when(F.col("total_amount") == 30.0, F.lit(None).cast("int")).otherwise(F.lit(2)),
            "airport_fee": F.lit(None).cast("double"),
        }
    )
    table = odd.unionByName(trips)
    for insight in insights.INSIGHTS:
        direct, rolled = insight(table, None).collect(), insight(rollup(table), None).collect()
        assert all(same(a, b) for x, y in zip(direct, rolled, strict=True) for a, b in zip(x, y)), insight.name


def test_an_insight_outside_the_cell_sets_is_refused(clean_table):
    mixed = insights.Insight("mixed", ("pickup_hour", "pickup_borough"), (insights.rows(),))
    with pytest.raises(ValueError):
        mixed(rollup(clean_table))


def test_ties_follow_the_keys(make_trips, zones):
    trips = clean_trips(make_trips({"PULocationID": 7}, {"PULocationID": 1}, {"PULocationID": 4}), zones)
    assert [r["pickup_borough"] for r in insights.top_routes(trips).collect()] == ["EWR", "Manhattan", "Queens"]


def test_airport_condition(make_trips, zones):
    trips = clean_trips(
        make_trips(
            {"PULocationID": 1},
            {"DOLocationID": 1},
            {"airport_fee": 1.25},
            {"airport_fee": 0.0},
            {"airport_fee": None},
            {"airport_fee": -1.25},
        ),
        zones,
    )
    got = insights.airport_trips(trips).collect()
    assert sum(r["trip_count"] for r in got) == 3
    # A null fee neither lets a trip in nor keeps an airport trip out.
    unfilled = trips.withColumn("airport_fee", F.lit(None).cast("double"))
    assert sum(r["trip_count"] for r in insights.airport_trips(unfilled).collect()) == 2


def test_fare_per_mile_is_a_mean_of_ratios(make_trips, zones):
    trips = clean_trips(
        make_trips({"trip_distance": 1.0, "total_amount": 10.0}, {"trip_distance": 10.0, "total_amount": 20.0}), zones
    )
    assert insights.fare_efficiency(trips).first()["avg_fare_per_mile"] == 6.0


def test_enrichment(make_trips, zones):
    got = enrich(clean_trips(make_trips({"trip_distance": 10.0}), zones)).first()
    assert (got["pickup_hour"], got["pickup_day_of_week"], got["pickup_month"], got["pickup_year"]) == (10, 4, 6, 2019)
    assert got["speed_mph"] == 20.0


def test_plans_stay_in_the_jvm_and_read_few_columns(clean_table):
    for insight in insights.INSIGHTS:
        plan = plan_text(insight(clean_table))
        assert "Python" not in plan and "ArrowEval" not in plan
    yearly = plan_text(insights.yearly_trends(clean_table))
    scan = yearly[yearly.rindex("FileScan") :]
    assert "ReadSchema: struct<trip_distance:double,total_amount:double>" in scan
    assert "PartitionFilters: [isnotnull(year" in scan
    assert "TakeOrderedAndProject" in plan_text(insights.top_routes(clean_table))


def test_written_report(spark, clean_table, tmp_path):
    timings, shared_seconds = report.write_report(clean_table, str(tmp_path / "shared"))
    assert [r["name"] for r in timings.collect()] == list(COLUMNS) and shared_seconds > 0
    report.write_report(clean_table, str(tmp_path / "scans"), [insights.peak_hours], shared_pass=False, fmt="csv")
    shared = spark.read.parquet(str(tmp_path / "shared/insight=peak_hours"))
    single = spark.read.option("header", True).csv(str(tmp_path / "scans/insight=peak_hours"))
    assert shared.columns == single.columns
    by_hour = lambda df: sorted((str(r["pickup_hour"]), str(r["trip_count"]), r["hour_label"]) for r in df.collect())
    assert by_hour(shared) == by_hour(single)
    stats, worst = report.timing_summary(timings)
    assert stats.first()["samples"] == 12 and worst.count() == 3


def test_presentation(spark, clean_table):
    text = report.formatted(insights.borough_stats(clean_table)).first()
    assert "," in text["total_revenue"] and text["total_revenue"][-3] == "."
    shares = [r["share_pct"] for r in report.with_share(insights.weekend_comparison(clean_table)).collect()]
    assert abs(sum(shares) - 100) < 0.11
    routes = report.with_route_labels(insights.top_routes(clean_table)).collect()
    counts = [r["trip_count"] for r in routes]
    assert counts == sorted(counts) and " → " in routes[0]["route_label"]
