"""Raw trip files of any vintage to the eight standard columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.schemas import TARGETS, TRIP_SCHEMA, Target


def standard_column(target: Target, present: set[str]) -> Column:
    """First non-null value among the spellings present, in the standard type.

    Values that do not parse become null; a column absent under every spelling takes
    the target's default.
    """
    dtype = TRIP_SCHEMA[target.name].dataType
    found = [F.col(f"`{name}`").try_cast(dtype) for name in target.aliases if name in present]
    value = F.coalesce(*found) if found else F.lit(target.absent).cast(dtype)
    return value.alias(target.name)


def standardize(raw: DataFrame) -> DataFrame:
    """Project any raw frame to ``TRIP_SCHEMA``, columns in fixed order."""
    present = set(raw.columns)
    return raw.select(*[standard_column(target, present) for target in TARGETS])


def union_standard(frames: list[DataFrame]) -> DataFrame:
    """Stack standardized frames by column name."""
    if not frames:
        raise ValueError("no trip data to union")
    return reduce(DataFrame.unionByName, frames)
