"""The cleaning job over files as they arrive, and hourly counts from it.

Both reuse the batch functions; cleaning keeps no state, the counts keep one row per
hour and borough. No trip is ever too late to be counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripweave.operators.standardize import standardize
from tripweave.operators.zones import measure_zones
from tripweave.plans.etl import clean_trips
from tripweave.schemas import CLEAN_SCHEMA, PARTITION_SCHEMA, TRIP_SCHEMA, Era
from tripweave.session import case_sensitive, written
from tripweave.sources import snapshots
from tripweave.sources.writers import LAYOUT_KEYS, with_layout_columns, write_clean


def stream_era(spark: SparkSession, era: Era, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Files of one era arriving in a folder, standardized."""
    return standardize(_reader(case_sensitive(spark), files_per_batch).schema(era.schema).parquet(path))


def stream_standard(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Standardized trip files arriving in a folder."""
    return _reader(spark, files_per_batch).schema(TRIP_SCHEMA).parquet(path)


def _reader(spark: SparkSession, files_per_batch: int | None):
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def append_clean(cleaned: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a cleaned stream to the year/month table through the transactional file sink."""
    writer = (
        with_layout_columns(cleaned)
        .writeStream.format("parquet")
        .partitionBy(*LAYOUT_KEYS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def hourly_borough_counts(cleaned: DataFrame) -> DataFrame:
    """Trips per pickup hour and borough, over all that has arrived.

    There is no watermark: files come in any order of months, and one reading with a clock
    that is ahead must not close the hours of all others. The state is bounded by the
    calendar. The hour is cut off the wall clock, so no time zone takes part.
    """
    past_hour = "make_dt_interval(0, 0, minute(pickup_datetime), extract(SECOND FROM pickup_datetime))"
    hour = F.expr(f"pickup_datetime - {past_hour}").alias("hour_start")
    return cleaned.groupBy(hour, "pickup_borough").agg(F.count(F.lit(1)).alias("trip_count"))


COMPACT_EVERY = 16  # batches whose counts are merged into one snapshot
COUNTS_DDL = "hour_start timestamp_ntz, pickup_borough string, trip_count long"
KEYS = ["hour_start", "pickup_borough"]


def write_hourly_counts(
    counts: DataFrame, path: str, checkpoint: str, once: bool = False, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep a table of streamed counts up to date.

    Each batch writes the counts it changed to ``changes/batch=N``; a batch that is repeated after
    a failure replaces that folder. Every ``compact_every`` batches they are merged with the last snapshot into
    the next one, which says up to which batch it reaches; only then the merged folders go. So
    there are never more than two snapshots and a few batches, however long the stream runs.
    """

    def put(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        changed.write.mode("overwrite").parquet(f"{path}/changes/batch={batch}")
        if batch % compact_every == compact_every - 1:
            compact_counts(spark, path)

    writer = counts.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def compact_counts(spark: SparkSession, path: str) -> None:
    """Merge the batches written since the last snapshot into the next one and remove them."""
    upto, batches = _counts_state(spark, path)
    if not batches:
        return
    last = batches[-1]
    merged = _merged_counts(spark, path, upto, batches).withColumn("upto", F.lit(last).cast("long"))
    # one file holds some millions of hours and boroughs; more are split by size
    snapshots.commit(merged.hint("rebalance"), f"{path}/snapshots")
    kept = snapshots.read(spark, f"{path}/snapshots", COUNTS_DDL + ", upto long").agg(F.max("upto")).first()[0]
    for batch in _batches(spark, path):
        if kept is not None and batch <= kept:
            snapshots.remove(spark, f"{path}/changes/batch={batch}")


def _batches(spark: SparkSession, path: str) -> list[int]:
    names = snapshots.children(spark, f"{path}/changes")
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def _counts_state(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The last batch that the last snapshot holds (-1 without one), and the complete batches after it."""
    upto = snapshots.read(spark, f"{path}/snapshots", COUNTS_DDL + ", upto long").agg(F.max("upto")).first()[0]
    upto = -1 if upto is None else upto
    done = [b for b in _batches(spark, path) if b > upto and snapshots.exists(spark, f"{path}/changes/batch={b}/_SUCCESS")]
    return upto, done


def _merged_counts(spark: SparkSession, path: str, upto: int, batches: list[int]) -> DataFrame:
    """A count only grows, so the greatest of an hour and borough is the last."""
    rows = snapshots.read(spark, f"{path}/snapshots", COUNTS_DDL + ", upto long").drop("upto")
    if batches:
        folders = [f"{path}/changes/batch={b}" for b in batches]
        rows = rows.unionByName(spark.read.schema(COUNTS_DDL).parquet(*folders))
    return rows.groupBy(*KEYS).agg(F.max("trip_count").alias("trip_count"))


def read_hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest counts: the last snapshot and the few batches after it."""
    return _merged_counts(spark, path, *_counts_state(spark, path))


def clean_batches(
    arriving: DataFrame,
    zones: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    once: bool = False,
    **cleaning: object,
) -> StreamingQuery:
    """Clean trips as they arrive, each batch with the zones as they are when it runs.

    ``zones`` reads the zone table. For every batch it is read and measured anew: ids that
    are no longer unique stop the stream before the batch is written, and a table that has outgrown
    the bound is joined by a shuffle. A batch writes to ``batch=N`` of its own, by year and month; repeated
    after a failure, it replaces what it left there.
    """

    def put(batch: DataFrame, number: int) -> None:
        own = written(zones(batch.sparkSession), "zones")  # one state of the table for the check and the join
        cleaned = clean_trips(batch, own, facts=measure_zones(own), **cleaning)
        write_clean(cleaned, f"{path}/batch={number}", shuffle=False)

    writer = arriving.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The trips that ``clean_batches`` wrote, with ``year`` and ``month``. Batches under way are not read."""
    schema = StructType(CLEAN_SCHEMA.fields + PARTITION_SCHEMA.fields)
    folders = [f"{path}/{n}" for n in snapshots.children(spark, path) if snapshots.exists(spark, f"{path}/{n}/_SUCCESS")]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)
