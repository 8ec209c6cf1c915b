"""One pass over the trips that answers every insight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.plans.insights import CELL_SETS, CELLS, ROLLED, prepared

PASSENGERS = "passengers_of_trip"
SUMMED = ("passenger_count", "total_amount", "trip_distance", "trip_duration_mins", "speed_mph", "fare_per_mile", "airport_fee")


def rollup(trips: DataFrame) -> DataFrame:
    """Partial sums for the cells of each key set in ``CELL_SETS``, from one read.

    No insight needs calendar, clock and route keys together, so they are summed apart
    (grouping sets): a few thousand cells instead of millions, which every task combines
    before the shuffle. A mean is kept as sum and non-null count, so means over any cells
    of a set are exact. ``cells`` names the set of a row; keys of other sets are null.
    """
    partial = [F.count(F.lit(1)).alias(ROLLED), F.max("trip_duration_mins").alias("trip_duration_mins_max")]
    for column in SUMMED:
        # passengers are also a key, which is null in the sets without it, so a copy is summed
        source = PASSENGERS if column == "passenger_count" else column
        partial += [F.sum(source).alias(f"{column}_sum"), F.count(source).alias(f"{column}_n")]
    keys = [key for members in CELL_SETS.values() for key in members]
    sets = [[F.col(key) for key in members] for members in CELL_SETS.values()]
    summed = (
        prepared(trips).withColumn(PASSENGERS, F.col("passenger_count")).groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("absent_keys"), *partial)
    )
    # grouping_id has one bit per key, first key highest, set where the key is left out.
    named = F.lit(None).cast("string")
    for name, members in CELL_SETS.items():
        absent = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in members)
        named = F.when(F.col("absent_keys") == absent, name).otherwise(named)
    return summed.withColumn(CELLS, named).drop("absent_keys")
