"""Text labels built from expressions, without Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of the reports.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
UNKNOWN = "Unknown"
CATEGORIES = (
    (10, "Long Haul (>10mi)"),
    (5, "Medium (5-10mi)"),
    (2, "Short (2-5mi)"),
)
SHORTEST_CATEGORY = "Very Short (<2mi)"
ARROW = " → "


def _nth(names: tuple[str, ...], number: Column) -> Column:
    # try_element_at is 1-based; the guard keeps 0 (an error) and negatives (from the end) out.
    listed = F.array(*[F.lit(name) for name in names])
    return F.coalesce(F.when(number >= 1, F.try_element_at(listed, number.cast("int"))), F.lit(UNKNOWN))


def day_name(number: Column) -> Column:
    """Day name, 1 = Sunday."""
    return _nth(DAY_NAMES, number)


def month_name(number: Column) -> Column:
    """Three-letter month name, 1 = Jan."""
    return _nth(MONTH_NAMES, number)


def is_weekend(day: Column) -> Column:
    """``Weekend`` for day 1 and 7, else ``Weekday``."""
    return F.when(day.isin(1, 7), "Weekend").otherwise("Weekday")


def trip_category(distance: Column) -> Column:
    """Distance class; exactly 2 miles and a null distance count as the shortest."""
    label = F.lit(SHORTEST_CATEGORY)
    for floor, name in reversed(CATEGORIES):
        label = F.when(distance > floor, name).otherwise(label)
    return label


def hour_label(hour: Column) -> Column:
    """Hour 0-23 on the 12-hour clock: ``12 AM``, ``7 PM``."""
    clock = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    return F.concat(clock.cast("string"), F.when(hour < 12, " AM").otherwise(" PM"))


def route_label(origin: Column, destination: Column) -> Column:
    """``origin → destination``; null when either end is null."""
    return F.concat(origin, F.lit(ARROW), destination)


def number_text(value: Column, digits: int = 2) -> Column:
    """Thousands-separated text."""
    return F.format_number(value, digits)


def magnitude_label(value: Column, million_digits: int = 1) -> Column:
    """Short count text: ``1.2M``, ``34K``, ``56``."""
    return (
        F.when(value >= 1e6, F.concat(_plain(value / 1e6, million_digits), F.lit("M")))
        .when(value >= 1e3, F.concat(_plain(value / 1e3, 0), F.lit("K")))
        .otherwise(_plain(value, 0))
    )


def _plain(value: Column, digits: int) -> Column:
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))
