"""The jobs end to end, from paths to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.operators.audit import file_months, file_schemas, missing_months, schema_runs, unreadable_files
from tripweave.plans.etl import clean_trips, clean_trips_basic
from tripweave.plans.report import timing_summary, write_report
from tripweave.sources.trips import ANY_MONTH, PREFIX, left_out, list_files, read_clean, read_drifting, read_eras
from tripweave.sources.writers import write_clean, write_compact
from tripweave.sources.zones import read_zones


def strict_etl(
    spark: SparkSession,
    raw_path: str,
    zones_path: str,
    out_path: str,
    prefix: str = PREFIX,
    zone: str | None = None,
    **layout: object,
) -> DataFrame:
    """Raw monthly files to the cleaned table; ``layout`` goes to ``write_clean``.

    Returns the files that were not read, with the reason.
    """
    trips = read_eras(spark, raw_path, prefix=prefix)
    zones = read_zones(trips.sparkSession, zones_path)
    write_clean(clean_trips(trips, zones, zone=zone), out_path, **layout)
    return left_out(spark, raw_path, prefix=prefix)


def basic_etl(
    spark: SparkSession, raw_path: str, zones_path: str, out_path: str, pattern: str = ANY_MONTH, files: int | None = None
) -> DataFrame:
    """The baseline job, files read by their own schemas; returns the files it skipped."""
    trips, rejects = read_drifting(spark, list_files(spark, raw_path, pattern))
    zones = read_zones(trips.sparkSession, zones_path)
    write_compact(clean_trips_basic(trips, zones), out_path, files)
    return rejects


def analytics(spark: SparkSession, clean_path: str, out_path: str, **options: object) -> tuple[DataFrame, DataFrame]:
    """Write the twelve insights; returns latency statistics and the slowest queries."""
    return timing_summary(write_report(read_clean(spark, clean_path), out_path, **options).timings)


def inspect_files(
    spark: SparkSession, raw_path: str, pattern: str = ANY_MONTH
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Schema runs over the files in date order, the months without a file, and the damaged files."""
    files = list_files(spark, raw_path, pattern)
    return schema_runs(files), missing_months(file_months(files)), unreadable_files(file_schemas(files))
