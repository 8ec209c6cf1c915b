"""Null filling, named quality rules and the attrition report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.temporal import in_years, minutes_between
from tripweave.schemas import FIRST_YEAR, LAST_YEAR

FILLS = {"passenger_count": 1, "airport_fee": 0.0}


@dataclass(frozen=True)
class Rule:
    """A named condition a valid trip meets; null counts as a failure."""

    name: str
    build: Callable[[], Column]

    def holds(self) -> Column:
        return F.coalesce(self.build(), F.lit(False))


def _rule(name: str, column: str, test: Callable[[Column], Column]) -> Rule:
    return Rule(name, lambda: test(F.col(column)))


DISTANCE_POSITIVE = _rule("distance_positive", "trip_distance", lambda c: c > 0)
DISTANCE_CAP = _rule("distance_cap", "trip_distance", lambda c: c <= 3000)
AMOUNT_POSITIVE = _rule("amount_positive", "total_amount", lambda c: c > 0)
AMOUNT_CAP = _rule("amount_cap", "total_amount", lambda c: c <= 2000)
DURATION_FLOOR = _rule("duration_floor", "trip_duration_mins", lambda c: c > 1)
DURATION_CAP = _rule("duration_cap", "trip_duration_mins", lambda c: c < 240)
PASSENGERS_POSITIVE = _rule("passengers_positive", "passenger_count", lambda c: c > 0)
PASSENGERS_CAP = _rule("passengers_cap", "passenger_count", lambda c: c <= 5)
PICKUP_ZONE_PRESENT = _rule("pickup_zone_present", "PULocationID", Column.isNotNull)
DROPOFF_ZONE_PRESENT = _rule("dropoff_zone_present", "DOLocationID", Column.isNotNull)
PICKUP_TIME_PRESENT = _rule("pickup_time_present", "pickup_datetime", Column.isNotNull)
DROPOFF_TIME_PRESENT = _rule("dropoff_time_present", "dropoff_datetime", Column.isNotNull)


def year_rules(first: int = FIRST_YEAR, last: int = LAST_YEAR) -> tuple[Rule, Rule]:
    """Both ends of a trip lie in a span of years."""
    return (
        _rule("pickup_year_range", "pickup_datetime", lambda c: in_years(c, first, last)),
        _rule("dropoff_year_range", "dropoff_datetime", lambda c: in_years(c, first, last)),
    )


BASIC_RULES = (
    DISTANCE_POSITIVE,
    AMOUNT_POSITIVE,
    PASSENGERS_POSITIVE,
    DURATION_FLOOR,
    DURATION_CAP,
)

SOUND_RULES = (
    DISTANCE_POSITIVE,
    DISTANCE_CAP,
    AMOUNT_POSITIVE,
    AMOUNT_CAP,
    DURATION_FLOOR,
    DURATION_CAP,
    PASSENGERS_POSITIVE,
    PASSENGERS_CAP,
    PICKUP_ZONE_PRESENT,
    DROPOFF_ZONE_PRESENT,
    PICKUP_TIME_PRESENT,
    DROPOFF_TIME_PRESENT,
)


def strict_rules(first: int = FIRST_YEAR, last: int = LAST_YEAR) -> tuple[Rule, ...]:
    """All rules of the strict job, for trips of these years."""
    return (*SOUND_RULES, *year_rules(first, last))


STRICT_RULES = strict_rules()


def fill_defaults(trips: DataFrame) -> DataFrame:
    """Null passengers become 1, a null airport fee 0.0."""
    return trips.fillna(FILLS)


def with_duration(trips: DataFrame, zone: str | None = None) -> DataFrame:
    """Add ``trip_duration_mins``, rounded to two digits."""
    minutes = minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime"), zone=zone)
    return trips.withColumn("trip_duration_mins", minutes)


def apply_rules(trips: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows that meet every rule.

    The bare conditions are used, not ``holds()``: a filter drops null anyway, and only
    plain comparisons reach the Parquet reader.
    """
    return trips.filter(reduce(Column.__and__, [rule.build() for rule in rules]))


def clean(
    trips: DataFrame,
    rules: Sequence[Rule] = STRICT_RULES,
    fill_first: bool = True,
    zone: str | None = None,
) -> DataFrame:
    """Fill, add the duration and apply ``rules``.

    ``fill_first=False`` filters before filling, which drops rows whose passenger count
    is null.
    """
    if fill_first:
        return apply_rules(with_duration(fill_defaults(trips), zone), rules)
    return fill_defaults(apply_rules(with_duration(trips, zone), rules))


def attrition(trips: DataFrame, rules: Sequence[Rule] = STRICT_RULES) -> DataFrame:
    """How many rows each rule rejects, from one aggregate over the data.

    One row per rule: ``step`` (1-based), ``rule``, ``rows_before`` (survivors of the
    earlier rules), ``rows_after``, ``failing_alone`` (rows the rule rejects by itself)
    and ``removed_pct`` (share of all rows removed up to and including this rule).
    Expects the columns the rules test, so call it after ``with_duration``.
    """
    judged = trips.select(F.array(*[rule.holds() for rule in rules]).alias("passed"))
    # The rule that removes a row (0: none): one number from which every survivor count follows.
    removed = judged.withColumn("removed_at", F.expr("array_position(passed, false)"))
    steps = range(len(rules))
    totals = removed.agg(
        F.count(F.lit(1)).alias("total"),
        F.expr(f"array({', '.join(f'count_if(NOT passed[{i}])' for i in steps)})").alias("failing"),
        F.expr(f"array({', '.join(f'count_if(removed_at = {i + 1})' for i in steps)})").alias("gone"),
    )
    names = F.array(*[F.lit(rule.name) for rule in rules])
    rows = totals.select("total", "failing", "gone", F.posexplode(names).alias("at", "rule"))
    lost = "aggregate(slice(gone, 1, {}), 0L, (upto, n) -> upto + n)"
    return rows.select(
        (F.col("at") + 1).alias("step"),
        "rule",
        F.expr(f"total - {lost.format('at')}").alias("rows_before"),
        F.expr(f"total - {lost.format('at + 1')}").alias("rows_after"),
        F.expr("failing[at]").alias("failing_alone"),
        F.expr(f"try_divide(100.0D * {lost.format('at + 1')}, total)").alias("removed_pct"),
    )
