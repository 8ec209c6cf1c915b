"""Per-trip ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def speed_mph(distance: Column, minutes: Column) -> Column:
    """Miles per hour; null where the duration is null or not positive."""
    return F.when(minutes > 0, distance / (minutes / F.lit(60)))


def fare_per_mile(amount: Column, distance: Column) -> Column:
    """Amount per mile; null where the distance is zero or null."""
    return F.try_divide(amount, distance)


def share_percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``."""
    return F.round(F.lit(100.0) * part / whole, digits)
