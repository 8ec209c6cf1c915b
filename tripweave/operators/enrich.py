"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels, ratios
from tripweave.functions.temporal import in_years


def enrich(trips: DataFrame) -> DataFrame:
    """Add pickup hour, day of week (1 = Sunday), month, year and speed.

    On a table laid out by ``year`` and ``month`` those partition columns are reused:
    queries by year or month then need not read the timestamps at all.
    """
    pickup = F.col("pickup_datetime")
    stored = {"year", "month"} <= set(trips.columns)
    return trips.withColumns(
        {
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": F.dayofweek(pickup),
            "pickup_month": F.col("month") if stored else F.month(pickup),
            "pickup_year": F.col("year") if stored else F.year(pickup),
            "speed_mph": ratios.speed_mph(F.col("trip_distance"), F.col("trip_duration_mins")),
        }
    )


def classify(enriched: DataFrame) -> DataFrame:
    """Add the grouping labels, flags and ratios the insights use.

    The flags keep null as null, so a filter on them behaves like the comparison.
    """
    distance = F.col("trip_distance")
    return enriched.withColumns(
        {
            "trip_category": labels.trip_category(distance),
            "is_weekend": labels.is_weekend(F.col("pickup_day_of_week")),
            "fare_per_mile": ratios.fare_per_mile(F.col("total_amount"), distance),
            "has_speed": F.col("speed_mph").isNotNull(),
            "has_distance": distance > 0,
            "has_airport_fee": F.col("airport_fee") > 0,
        }
    )


def within_years(trips: DataFrame, first: int, last: int) -> DataFrame:
    """Trips picked up in a span of years.

    Filters the ``year`` partition column where there is one, so whole directories are
    skipped, and otherwise a timestamp range that reaches the Parquet reader.
    """
    if "year" in trips.columns:
        return trips.filter(F.col("year").between(first, last))
    return trips.filter(in_years(F.col("pickup_datetime"), first, last))
