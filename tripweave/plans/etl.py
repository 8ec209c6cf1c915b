"""The two cleaning jobs, from standardized trips to the cleaned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.quality import BASIC_RULES, STRICT_RULES, Rule, clean
from tripweave.operators.zones import ZoneFacts, with_zones
from tripweave.schemas import CLEAN_SCHEMA, EXCLUDED_BOROUGHS


def clean_trips(
    trips: DataFrame,
    zones: DataFrame,
    exclude: Sequence[str] = EXCLUDED_BOROUGHS,
    zone: str | None = None,
    strategy: str = "auto",
    facts: ZoneFacts | None = None,
    rules: Sequence[Rule] = STRICT_RULES,
) -> DataFrame:
    """Fill, strict rules, zone lookup: the table every analysis starts from.

    ``rules=strict_rules(first, last)`` takes other years than the default ones.
    """
    valid = clean(trips, rules, zone=zone)
    return with_zones(valid, zones, exclude, strategy, facts=facts).select(*CLEAN_SCHEMA.names)


def clean_trips_basic(trips: DataFrame, zones: DataFrame, strategy: str = "auto") -> DataFrame:
    """The baseline job: five rules, filter before fill."""
    located = with_zones(trips, zones, strategy=strategy, details=True)
    valid = clean(located, BASIC_RULES, fill_first=False)
    return valid.select(
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        "trip_duration_mins",
        "trip_distance",
        "total_amount",
        "passenger_count",
        "airport_fee",
        "pickup_borough",
        "dropoff_borough",
    )
