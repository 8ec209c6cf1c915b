"""Clock arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(text: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column, digits: int = 2, zone: str | None = None) -> Column:
    """Minutes from ``start`` to ``end``, rounded half up to 0-7 digits.

    By default both are wall-clock readings and no zone is involved. With ``zone`` they
    are read as local times there, so a shift of the clock counts as elapsed time.

    The interval is divided down to the wanted unit, which Spark does half up in whole
    numbers; ``timestamp_diff`` and ``round`` on doubles cost several times as much, and
    this runs on every raw row.
    """
    if zone is not None:
        start, end = (F.convert_timezone(F.lit(zone), F.lit("UTC"), ts) for ts in (start, end))
    units = 10**digits
    counted = (end - start) / F.lit(60_000_000 // units)  # one microsecond per unit
    return (counted * F.lit(1_000_000)).cast("bigint") / F.lit(float(units))


def in_years(ts: Column, first: int, last: int) -> Column:
    """``first <= year(ts) <= last`` as a half-open range, which Parquet can push down."""
    return (ts >= wall_clock(f"{first}-01-01")) & (ts < wall_clock(f"{last + 1}-01-01"))
