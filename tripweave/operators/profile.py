"""Column profiles of a trip table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators.ranks import SKETCH_SIZE, bracketed, discrete_index

RAW_NUMBERS = ("trip_distance", "total_amount", "passenger_count", "airport_fee")
CLEAN_NUMBERS = (*RAW_NUMBERS, "trip_duration_mins")
QUARTILES = {"25%": 0.25, "50%": 0.50, "75%": 0.75}
STATISTICS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def year_range(trips: DataFrame) -> DataFrame:
    """First and last pickup and dropoff year."""
    bounds = [
        bound(F.year(f"{end}_datetime")).alias(f"{word}_{end}_year")
        for end in ("pickup", "dropoff")
        for bound, word in ((F.min, "min"), (F.max, "max"))
    ]
    return trips.agg(*bounds)


def numeric_profile(
    trips: DataFrame, columns: Sequence[str] = CLEAN_NUMBERS, exact: bool = False, size: int = SKETCH_SIZE
) -> DataFrame:
    """One row per statistic (``summary``) and one double column per input column.

    Quartiles come from mergeable sketches of all columns, in the same pass as the other statistics
    (off by a rank of at most ``rank_margin(size)``). With ``exact`` the sketches bracket them and one more pass
    over all columns counts them out.
    """
    picks = {name: discrete_index(p) for name, p in QUARTILES.items()}
    simple = {"count": lambda c: F.count(c).cast("double"), "mean": F.avg, "stddev": F.stddev_samp}
    simple |= {"min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double")}
    wanted = [make(c).alias(f"{c}|{name}") for name, make in simple.items() for c in columns]
    if exact:
        wide = trips.agg(*wanted)
        ranked = bracketed(trips, columns, picks, k=size)
        split = [F.col(f"`{c}`.`{name}`").alias(f"{c}|{name}") for c in columns for name in picks]
        # one row each; without any trips there are no ranks
        wide = wide.join(F.broadcast(ranked.select(*split)), F.lit(True), "left")
    else:
        sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"{c}|sketch") for c in columns]
        split = {
            f"{c}|{name}": F.when(F.col(f"`{c}|count`") > 0, F.kll_sketch_get_quantile_double(F.col(f"`{c}|sketch`"), F.lit(p)))
            for c in columns
            for name, p in QUARTILES.items()
        }
        wide = trips.agg(*wanted, *sketches).withColumns(split)
    position = reduce(
        lambda chain, item: chain.when(F.col("summary") == item[1], F.lit(item[0])),
        enumerate(STATISTICS[1:], 1),
        F.when(F.col("summary") == STATISTICS[0], F.lit(0)),
    )
    return wide.select(F.inline(F.array(*[_profile_row(name, columns) for name in STATISTICS]))).orderBy(position)


def _profile_row(name: str, columns: Sequence[str]) -> Column:
    return F.struct(F.lit(name).alias("summary"), *[F.col(f"`{c}|{name}`").alias(c) for c in columns])


def preview(trips: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in order of pickup time, the other columns breaking ties."""
    rest = [c for c in trips.columns if c != "pickup_datetime"]
    return trips.orderBy("pickup_datetime", *rest).limit(rows)
