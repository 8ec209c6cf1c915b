"""The aggregate queries, declared once and run over trips or over the rollup.

An ``Insight`` names its grouping keys, its measures and the order of its result. The
measures are counts, means, totals and peaks, all of which can be computed either from
trip rows or from partial sums, so the same declaration serves both.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels
from tripweave.operators.enrich import classify, enrich, within_years
from tripweave.schemas import AIRPORT_BOROUGHS, FIRST_YEAR, LAST_YEAR

ROLLED = "trip_rows"  # row count of a rollup cell; its presence marks a rollup
CELLS = "cells"  # which of the sets below a rollup cell belongs to

# The keys and flags the insights use, in groups that are never combined.
CELL_SETS = {
    "calendar": ("pickup_year", "pickup_month"),
    "clock": ("pickup_day_of_week", "is_weekend", "pickup_hour", "has_speed"),
    "route": (
        "pickup_borough",
        "dropoff_borough",
        "passenger_count",
        "trip_category",
        "has_distance",
        "has_airport_fee",
    ),
}


@dataclass(frozen=True)
class Measure:
    """One output number: ``kind`` is rows, mean, total or peak."""

    name: str
    kind: str
    column: str = ""
    digits: int | None = 2  # at most this many when the caller rounds

    def over_rows(self) -> Column:
        if self.kind == "rows":
            return F.count(F.lit(1))
        return {"mean": F.avg, "total": F.sum, "peak": F.max}[self.kind](self.column)

    def over_cells(self) -> Column:
        if self.kind == "rows":
            return F.sum(ROLLED)
        if self.kind == "mean":
            return F.try_divide(F.sum(f"{self.column}_sum"), F.sum(f"{self.column}_n"))
        return {"total": F.sum, "peak": F.max}[self.kind](f"{self.column}_{'sum' if self.kind == 'total' else 'max'}")

    def check(self, rollup: DataFrame) -> None:
        """Refuse what a rollup does not hold."""
        parts = {"rows": (), "mean": ("sum", "n"), "total": ("sum",), "peak": ("max",)}[self.kind]
        if missing := [f"{self.column}_{part}" for part in parts if f"{self.column}_{part}" not in rollup.columns]:
            raise ValueError(f"{self.name} cannot be computed from the rollup, which lacks {missing}")

    def expression(self, rolled: bool, digits: int | None) -> Column:
        value = self.over_cells() if rolled else self.over_rows()
        if digits is not None and self.digits is not None and self.kind != "rows":
            value = F.round(value, min(digits, self.digits))
        return value.alias(self.name)


def rows(name: str = "trip_count") -> Measure:
    return Measure(name, "rows")


def mean(column: str, name: str, digits: int | None = 2) -> Measure:
    return Measure(name, "mean", column, digits)


def total(column: str, name: str) -> Measure:
    return Measure(name, "total", column)


def peak(column: str, name: str) -> Measure:
    return Measure(name, "peak", column)


def prepared(trips: DataFrame) -> DataFrame:
    """Add whichever derived columns a clean table still lacks."""
    if "has_airport_fee" in trips.columns:
        return trips
    return classify(trips if "speed_mph" in trips.columns else enrich(trips))


@dataclass(frozen=True)
class Insight:
    """A declared aggregate query. Call it with a clean table, enriched or not, or a rollup."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    order: tuple[str, ...] = ()  # "-name" sorts descending; the keys break ties
    top: int | None = None
    keep: Callable[[DataFrame], DataFrame] | None = None
    flags: tuple[str, ...] = ()  # columns ``keep`` reads besides the keys
    label: tuple[str, Callable[[], Column]] | None = None
    show_keys: bool = True

    def __call__(self, trips: DataFrame, digits: int | None = 2) -> DataFrame:
        needed = {*self.keys, *[m.column for m in self.measures if m.column]}
        bare = self.keep is None and needed <= set(trips.columns)
        rolled = ROLLED in trips.columns
        if rolled:
            for measure in self.measures:
                measure.check(trips)
            source = trips.filter(F.col(CELLS) == self.cell_set())
        else:
            source = trips if bare else prepared(trips)
        if self.keep:
            source = self.keep(source)
        summary = source.groupBy(*self.keys).agg(*[m.expression(rolled, digits) for m in self.measures])
        ordered = summary.orderBy(*[F.desc(o[1:]) if o[0] == "-" else F.asc(o) for o in self._full_order()])
        if self.top:
            ordered = ordered.limit(self.top)
        return ordered.select(*self._output())

    def cell_set(self) -> str:
        """The rollup set that has all keys of this insight."""
        for name, members in CELL_SETS.items():
            if {*self.keys, *self.flags} <= set(members):
                return name
        raise ValueError(f"{self.name} cannot be computed from the rollup")

    def _full_order(self) -> tuple[str, ...]:
        named = {o.lstrip("-") for o in self.order}
        return self.order + tuple(k for k in self.keys if k not in named)

    def _output(self) -> list[Column]:
        keys = [F.col(k) for k in self.keys] if self.show_keys else []
        numbers = [F.col(m.name) for m in self.measures]
        if not self.label:
            return keys + numbers
        name, build = self.label
        text = build().alias(name)
        return [*keys, *numbers, text] if self.show_keys else [text, *numbers]


AMOUNT, DISTANCE, MINUTES = "total_amount", "trip_distance", "trip_duration_mins"
FARE = mean(AMOUNT, "avg_fare")
LENGTH = mean(DISTANCE, "avg_distance")
TIME = mean(MINUTES, "avg_duration_mins")
SPEED = mean("speed_mph", "avg_speed_mph")
ROUTE = ("pickup_borough", "dropoff_borough")


def _flagged(flag: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.filter(F.col(flag))


def _covered_years(df: DataFrame) -> DataFrame:
    if ROLLED in df.columns:
        return df.filter(F.col("pickup_year").between(FIRST_YEAR, LAST_YEAR))
    return within_years(df, FIRST_YEAR, LAST_YEAR)


def touching_airports(boroughs: Sequence[str] = AIRPORT_BOROUGHS) -> Callable[[DataFrame], DataFrame]:
    """Trips that start or end in an airport borough, or paid an airport fee."""

    def keep(df: DataFrame) -> DataFrame:
        ends = [F.col(end).isin(*boroughs) for end in ROUTE]
        return df.filter(reduce(Column.__or__, [*ends, F.col("has_airport_fee")]))

    return keep


borough_stats = Insight(
    "borough_stats",
    ("pickup_borough",),
    (rows(), FARE, LENGTH, TIME, total(AMOUNT, "total_revenue"), mean("passenger_count", "avg_passengers")),
    order=("-avg_fare",),
)
congestion_by_hour = Insight(
    "congestion_by_hour",
    ("pickup_hour",),
    (SPEED, rows(), TIME),
    keep=_flagged("has_speed"),
    flags=("has_speed",),
)
yearly_trends = Insight("yearly_trends", ("pickup_year",), (rows(), FARE, LENGTH), keep=_covered_years)
trip_categories = Insight(
    "trip_categories",
    ("trip_category",),
    (rows(), mean(AMOUNT, "avg_cost"), LENGTH, mean("passenger_count", "avg_passengers", digits=1), TIME),
    order=("-avg_cost",),
)
dow_patterns = Insight(
    "dow_patterns",
    ("pickup_day_of_week",),
    (rows(), FARE, SPEED),
    label=("day_name", lambda: labels.day_name(F.col("pickup_day_of_week"))),
    show_keys=False,
)
top_routes = Insight("top_routes", ROUTE, (rows(), FARE, LENGTH), order=("-trip_count",), top=10)
monthly_patterns = Insight(
    "monthly_patterns",
    ("pickup_month",),
    (rows(), FARE, LENGTH, SPEED),
    label=("month_name", lambda: labels.month_name(F.col("pickup_month"))),
    show_keys=False,
)
airport_trips = Insight(
    "airport_trips",
    ROUTE,
    (rows(), FARE, LENGTH, TIME, total("airport_fee", "total_airport_fees")),
    order=("-trip_count",),
    top=15,
    keep=touching_airports(),
    flags=("has_airport_fee",),
)
passenger_patterns = Insight("passenger_patterns", ("passenger_count",), (rows(), FARE, LENGTH, TIME))
fare_efficiency = Insight(
    "fare_efficiency",
    ("pickup_borough",),
    (rows(), mean("fare_per_mile", "avg_fare_per_mile"), FARE, LENGTH),
    order=("-avg_fare_per_mile",),
    keep=_flagged("has_distance"),
    flags=("has_distance",),
)
weekend_comparison = Insight("weekend_comparison", ("is_weekend",), (rows(), FARE, LENGTH, SPEED, TIME))
peak_hours = Insight(
    "peak_hours",
    ("pickup_hour",),
    (rows(), FARE, SPEED, total(AMOUNT, "total_revenue")),
    order=("-trip_count",),
    top=10,
    label=("hour_label", lambda: labels.hour_label(F.col("pickup_hour"))),
)

# The twelve numbered insights, in report order.
INSIGHTS = (
    borough_stats,
    congestion_by_hour,
    yearly_trends,
    trip_categories,
    dow_patterns,
    top_routes,
    monthly_patterns,
    airport_trips,
    passenger_patterns,
    fare_efficiency,
    weekend_comparison,
    peak_hours,
)

# Borough summaries used while the cleaning jobs were being checked; never rounded.
baseline_borough = Insight(
    "baseline_borough",
    ("pickup_borough",),
    (
        mean(DISTANCE, "avg_trip_distance", None),
        mean(AMOUNT, "avg_total_amount", None),
        replace(peak(MINUTES, "max_trip_duration"), digits=None),
        rows("total_trips"),
    ),
)
borough_counts = Insight("borough_counts", ("pickup_borough",), (rows("count"),), order=("-count",))
borough_means = Insight(
    "borough_means",
    ("pickup_borough",),
    (
        mean(DISTANCE, "avg_dist", None),
        mean(AMOUNT, "avg_cost", None),
        mean(MINUTES, "avg_time", None),
        mean("passenger_count", "avg_passengers", None),
        mean("airport_fee", "avg_airport_fee", None),
    ),
    order=("-avg_cost",),
)


def for_airports(boroughs: Sequence[str]) -> Insight:
    """``airport_trips`` for other airport boroughs."""
    return replace(airport_trips, keep=touching_airports(boroughs))
