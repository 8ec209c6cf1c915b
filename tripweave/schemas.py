"""Table schemas, the three source eras and the column-alias table.

The values in this file are fixed: they describe what the published trip files
look like and what the cleaned table must look like.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TIME, LONG, INT, DOUBLE, TEXT = TimestampNTZType(), LongType(), IntegerType(), DoubleType(), StringType()


def table(*columns: tuple[str, DataType]) -> StructType:
    """All columns nullable."""
    return StructType([StructField(name, dtype) for name, dtype in columns])


TRIP_SCHEMA = table(
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("PULocationID", LONG),
    ("DOLocationID", LONG),
    ("trip_distance", DOUBLE),
    ("total_amount", DOUBLE),
    ("passenger_count", INT),
    ("airport_fee", DOUBLE),
)

CLEAN_SCHEMA = StructType(
    TRIP_SCHEMA.fields
    + table(("trip_duration_mins", DOUBLE), ("pickup_borough", TEXT), ("dropoff_borough", TEXT)).fields
)

PARTITION_SCHEMA = table(("year", INT), ("month", INT))

ZONE_SCHEMA = table(("LocationID", INT), ("Borough", TEXT), ("Zone", TEXT), ("service_zone", TEXT))


@dataclass(frozen=True)
class Era:
    """A span of months whose files share one set of physical column types."""

    name: str
    first: tuple[int, int]
    last: tuple[int, int]
    schema: StructType

    def name_pattern(self, prefix: str = "yellow_tripdata_") -> str:
        """Glob over file names ``<prefix>YYYY-MM.parquet`` inside this era.

        A whole year becomes ``YYYY-*``; only the edge years list their months.
        """
        spans = []
        for year in range(self.first[0], self.last[0] + 1):
            start = self.first[1] if year == self.first[0] else 1
            stop = self.last[1] if year == self.last[0] else 12
            if (start, stop) == (1, 12):
                spans.append(f"{year}-*")
            else:
                spans.extend(f"{year}-{month:02d}" for month in range(start, stop + 1))
        return f"{prefix}{{{','.join(spans)}}}.parquet"


SHARED = table(
    ("tpep_pickup_datetime", TIME),
    ("tpep_dropoff_datetime", TIME),
    ("trip_distance", DOUBLE),
    ("total_amount", DOUBLE),
    ("PULocationID", LONG),
    ("DOLocationID", LONG),
)


def _era_schema(passengers: DataType, *extra: tuple[str, DataType]) -> StructType:
    return StructType(SHARED.fields + table(("passenger_count", passengers), *extra).fields)


TEXT_TIMES = (("pickup_datetime", TEXT), ("dropoff_datetime", TEXT))
BOTH_FEES = (("airport_fee", DOUBLE), ("Airport_fee", DOUBLE))

# A double file column cannot be read as long (nor the reverse), so the eras split
# where the physical type of passenger_count changes.
LEGACY = Era("legacy", (2011, 1), (2018, 6), _era_schema(LONG, *TEXT_TIMES))
MIDDLE = Era("middle", (2018, 7), (2023, 1), _era_schema(DOUBLE, *BOTH_FEES))
MODERN = Era("modern", (2023, 2), (2024, 12), _era_schema(LONG, *BOTH_FEES))
ERAS = (LEGACY, MIDDLE, MODERN)


@dataclass(frozen=True)
class Target:
    """One standard column: the spellings it may have, in priority order."""

    name: str
    aliases: tuple[str, ...]
    absent: Any = None  # value when no spelling is present in the file


TARGETS = (
    Target("pickup_datetime", ("tpep_pickup_datetime", "pickup_datetime", "Trip_Pickup_DateTime")),
    Target("dropoff_datetime", ("tpep_dropoff_datetime", "dropoff_datetime", "Trip_Dropoff_DateTime")),
    Target("PULocationID", ("PULocationID",)),
    Target("DOLocationID", ("DOLocationID",)),
    Target("trip_distance", ("trip_distance", "Trip_Distance")),
    Target("total_amount", ("total_amount", "Total_Amt")),
    Target("passenger_count", ("passenger_count", "Passenger_Count")),
    Target("airport_fee", ("airport_fee", "Airport_fee"), absent=0.0),
)

EXCLUDED_BOROUGHS = ("Unknown", "N/A")
AIRPORT_BOROUGHS = ("EWR",)
FIRST_YEAR, LAST_YEAR = 2011, 2024
