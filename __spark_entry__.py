"""Registered queries and their oracle SQL."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from tripweave import fixtures  # noqa: E402
from tripweave.operators import audit, latency, profile, quality, zones  # noqa: E402
from tripweave.operators.enrich import enrich  # noqa: E402
from tripweave.plans import incremental, insights, report  # noqa: E402
from tripweave.plans.etl import clean_trips, clean_trips_basic  # noqa: E402
from tripweave.plans.rollup import rollup  # noqa: E402
from tripweave.schemas import TRIP_SCHEMA  # noqa: E402
from tripweave.session import scratch_path, written  # noqa: E402
from tripweave.sources import ledger, snapshots, writers  # noqa: E402
from tripweave.sources import trips as sources  # noqa: E402
from tripweave.sources.zones import read_zones  # noqa: E402
from tripweave.streaming import live  # noqa: E402

try:
    import corpus_pipeline
    from tripweave.llm import queries as llm
except ModuleNotFoundError as missing:  # the subpackage and its pipeline are optional
    if missing.name not in ("corpus_pipeline", "tripweave.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Means of ratios and of durations are not exact binary fractions, so summation order shows in their last
# digits; they are compared at four digits. Every other number is compared in full.
INEXACT = (
    "avg_speed_mph",
    "avg_fare_per_mile",
    "avg_duration_mins",
    "avg_time",
    "speed_mph_sum",
    "fare_per_mile_sum",
    "trip_duration_mins_sum",
)


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.order_trips(spark, folder)


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.nation_zones(spark, folder)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_trips(_raw(spark, folder), _zones(spark, folder))


def _basic(spark: SparkSession, folder: str) -> DataFrame:
    return clean_trips_basic(_raw(spark, folder), _zones(spark, folder))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet").select("event_type", "event_id", "value")


def _settled(result: DataFrame, digits: int = 4, columns: tuple[str, ...] = INEXACT) -> DataFrame:
    return result.withColumns({c: F.round(c, digits) for c in columns if c in result.columns})


def _insight(insight: insights.Insight) -> Query:
    return lambda spark, folder: _settled(insight(_clean(spark, folder), digits=None))


def _rounded(insight: insights.Insight) -> Query:
    """With the two digits of the reports."""
    return lambda spark, folder: insight(_clean(spark, folder))


def _from_rollup(insight: insights.Insight) -> Query:
    return lambda spark, folder: _settled(insight(rollup(_clean(spark, folder)), digits=None))


def _written(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "clean")
    writers.write_clean(_clean(spark, folder), path)
    return path


def _era_root(spark: SparkSession, folder: str) -> str:
    """The trips of a folder, stored the way the three eras stored theirs."""
    root = scratch_path(spark, "eras")
    _raw(spark, folder).write.parquet(f"{root}/all")
    fixtures.write_era_folders(spark.read.parquet(f"{root}/all"), f"{root}/raw")
    return f"{root}/raw"


def standardized_union(spark: SparkSession, folder: str) -> DataFrame:
    stored = fixtures.era_folders(_era_root(spark, folder)).values()
    return sources.union_standard([sources.read_era(spark, era, path) for era, path in stored])


def drifting_union(spark: SparkSession, folder: str) -> DataFrame:
    files = sources.list_files(spark, _era_root(spark, folder), "*.parquet")
    trips, _ = sources.read_drifting(spark, files)
    return trips


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    return audit.schema_runs(sources.list_files(spark, _era_root(spark, folder), "*.parquet"))


def one_file_standardized(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "one")
    _raw(spark, folder).withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    ).write.parquet(path)
    return sources.read_file(spark, path)


def written_report(spark: SparkSession, folder: str) -> DataFrame:
    """The borough statistics of a report written from one read of the cleaned table."""
    path = scratch_path(spark, "report")
    report.write_report(_clean(spark, folder), path)
    return spark.read.parquet(f"{path}/insight=borough_stats")


def compact_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "compact")
    writers.write_compact(_basic(spark, folder), path)
    return spark.read.parquet(path)


_month_roots: dict[tuple[str, str], str] = {}


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The trips of a folder, joined once in an application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _month_roots:
        path = scratch_path(spark, "trips")
        _raw(spark, folder).write.parquet(path)
        _month_roots[key] = path
    return spark.read.schema(TRIP_SCHEMA).parquet(_month_roots[key])


def _write_months(spark: SparkSession, folder: str, root: str, which: str = "true") -> None:
    """The trips of a folder, one file for each month, named by it."""
    fixtures.write_month_files(_stored(spark, folder).where(which), root)


def _damage_months(spark: SparkSession, folder: str, root: str) -> None:
    """Every fifth month's file is damaged."""
    month = F.date_format("pickup_datetime", "yyyy-MM").alias("file_month")
    fifth = _stored(spark, folder).where("(year(pickup_datetime) * 12 + month(pickup_datetime)) % 5 = 0")
    fixtures.damage_months(spark, root, fifth.select(month).distinct())


def skip_damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Trips read from each month's file; a damaged file is listed and gives none."""
    root = scratch_path(spark, "months")
    _write_months(spark, folder, root)
    _damage_months(spark, folder, root)
    known = written(audit.file_schemas(sources.list_files(spark, root)), "footers")
    trips, _ = sources.read_drifting(spark, known)
    read = trips.groupBy(F.date_format("pickup_datetime", "yyyy-MM").alias("file_month")).agg(F.count("*").alias("n"))
    files = known.select(sources.file_month().alias("file_month"), "verdict")
    return files.join(read, "file_month", "left").select("file_month", "verdict", F.coalesce("n", F.lit(0)).alias("trips"))


def eras_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """All files whose month is of an era, each read with the era's schema."""
    root = scratch_path(spark, "months")
    _write_months(spark, folder, root)
    return sources.read_eras(spark, root, fixtures.MONTH_ERAS)


def ingest_remainder(spark: SparkSession, folder: str) -> DataFrame:
    """What a ledger of two runs says of files that are not read: damaged, or of no era."""
    root, kept = scratch_path(spark, "months"), scratch_path(spark, "ledger")
    _write_months(spark, folder, root, "month(pickup_datetime) % 2 = 0")
    ledger.update(spark, root, kept, eras=fixtures.MONTH_ERAS)
    _write_months(spark, folder, root, "month(pickup_datetime) % 2 = 1")
    _damage_months(spark, folder, root)
    known = ledger.update(spark, root, kept, eras=fixtures.MONTH_ERAS)
    return ledger.remainder(known).select(sources.file_month().alias("file_month"), "reason")


def schema_runs_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of months with one schema: the first and last month and the number of files."""
    root = scratch_path(spark, "months")
    _write_months(spark, folder, root)
    runs = audit.schema_runs(sources.list_files(spark, root))
    ends = [F.regexp_extract(c, r"(\d{4}-\d{2})\.parquet$", 1) for c in ("first_file", "last_file")]
    return runs.select("run", ends[0].alias("first_month"), ends[1].alias("last_month"), "files")


def incremental_months(spark: SparkSession, folder: str) -> DataFrame:
    """A table after two loads: the second sees files that are new, corrected (2012) and gone (January 2013)."""
    root, kept, path = (scratch_path(spark, name) for name in ("months", "ledger", "table"))

    def load() -> None:
        incremental.load_changes(spark, root, _zones(spark, folder), path, kept, eras=fixtures.MONTH_ERAS)

    _write_months(spark, folder, root, "year(pickup_datetime) <> 2012 AND month(pickup_datetime) % 2 = 1")
    _write_months(spark, folder, root, "year(pickup_datetime) = 2012 AND day(pickup_datetime) < 9")
    load()
    _write_months(spark, folder, root, "year(pickup_datetime) = 2012 OR month(pickup_datetime) % 2 = 0")
    snapshots.remove(spark, fixtures.month_file(root, "2013-01"))
    load()
    return incremental.read_table(spark, path)


def _arrive(spark: SparkSession, folder: str, path: str, *keys: Column) -> int:
    """Put the trips of a folder into files, the more the larger it is; returns how many make a third of them."""
    files = fixtures.trip_pieces(spark, folder, 3)
    _raw(spark, folder).repartition(files, *keys).write.parquet(path)
    return -(-files // 3)


def streamed_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, each cleaned with the zone table as it is then."""
    path = scratch_path(spark, "stream")
    files = _arrive(spark, folder, f"{path}/in")
    _zones(spark, folder).write.parquet(f"{path}/zones")
    arriving = live.stream_standard(spark, f"{path}/in", files_per_batch=files)
    query = live.clean_batches(
        arriving, lambda session: session.read.parquet(f"{path}/zones"), f"{path}/out", f"{path}/progress", once=True
    )
    query.awaitTermination()
    return live.read_batches(spark, f"{path}/out")


def year_range(spark: SparkSession, folder: str) -> DataFrame:
    stages = (("raw", _raw(spark, folder)), ("clean", _clean(spark, folder)))
    raw, cleaned = (profile.year_range(df).withColumn("stage", F.lit(name)) for name, df in stages)
    return raw.unionByName(cleaned)


def _profiled(table: Query, columns: tuple[str, ...]) -> Query:
    return lambda spark, folder: _settled(
        profile.numeric_profile(table(spark, folder), columns, exact=True), columns=columns
    )


def streamed_clean(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "stream")
    _raw(spark, folder).write.parquet(f"{path}/in")
    arriving = live.stream_standard(spark, f"{path}/in")
    live.append_clean(
        clean_trips(arriving, _zones(spark, folder)), f"{path}/out", f"{path}/progress", once=True
    ).awaitTermination()
    return sources.read_clean(spark, f"{path}/out")


def streamed_hourly_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches of files of mixed months."""
    path = scratch_path(spark, "stream")
    files = _arrive(spark, folder, f"{path}/in", F.to_date("pickup_datetime"))
    arriving = live.stream_standard(spark, f"{path}/in", files_per_batch=files)
    counts = live.hourly_borough_counts(clean_trips(arriving, _zones(spark, folder)))
    live.write_hourly_counts(counts, f"{path}/out", f"{path}/progress", once=True, compact_every=2).awaitTermination()
    return live.read_hourly_counts(spark, f"{path}/out")


def coalesced_write(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "coalesced")
    files = fixtures.trip_pieces(spark, folder, 4)  # the work that feeds the write runs in so many tasks
    writers.write_compact(_basic(spark, folder), path, files=files, shuffle=False)
    return spark.read.parquet(path)


def replaced_month(spark: SparkSession, folder: str) -> DataFrame:
    """One month of a written table is written again; the others stay as they are."""
    path = _written(spark, folder)
    march = _clean(spark, folder).where("year(pickup_datetime) = 2012 AND month(pickup_datetime) = 3")
    writers.write_clean(march, path, replace_months_only=True)
    return sources.read_clean(spark, path)


def bucketed_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = scratch_path(spark, "bucketed").rsplit("/", 1)[1].replace("-", "_")
    writers.write_bucketed(_clean(spark, folder), table, 4)
    return spark.table(table).groupBy("pickup_borough").agg(F.count(F.lit(1)).alias("trip_count"))


def zones_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "zones")
    _zones(spark, folder).write.option("header", True).csv(path)
    return read_zones(spark, path)


def _joined(strategy: str) -> Query:
    return lambda spark, folder: zones.with_zones(
        quality.fill_defaults(_raw(spark, folder)), _zones(spark, folder), strategy=strategy, details=True
    )


def _latency(by: tuple[str, ...] = ("event_type",), **options: int) -> Query:
    return lambda spark, folder: _settled(
        latency.latency_stats(_events(spark, folder), by=by, **options), digits=6, columns=("mean_value",)
    )


def tail_class(spark: SparkSession, folder: str) -> DataFrame:
    stats = latency.latency_stats(_events(spark, folder), by=("event_type",))
    return latency.tail_class(stats).select("event_type", "p50", "p99", "tail_ratio", "tail_class")


def _slowest(by: tuple[str, ...]) -> Query:
    return lambda spark, folder: latency.slowest(_events(spark, folder), 3, by=by, ties=("event_id",))


def hour_labels(spark: SparkSession, folder: str) -> DataFrame:
    by_hour = insights.Insight("hour_counts", ("pickup_hour",), (insights.rows(),), label=insights.peak_hours.label)
    return by_hour(_clean(spark, folder))


def entry(spark: SparkSession) -> DataFrame:
    """Borough statistics over the cleaned trips."""
    return insights.borough_stats(_clean(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    """Every registered query, each over the whole tables of a folder."""
    named = {i.name: _insight(i) for i in insights.INSIGHTS}
    if llm:
        named |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return named | {
        **{f"{i.name}_2_digits": _rounded(i) for i in insights.INSIGHTS},
        "airport_trips": _insight(insights.for_airports(fixtures.AIRPORT_BOROUGH)),
        "airport_trips_2_digits": _rounded(insights.for_airports(fixtures.AIRPORT_BOROUGH)),
        "baseline_borough": lambda s, d: insights.baseline_borough(_basic(s, d)),
        "borough_counts": _insight(insights.borough_counts),
        "borough_means": _insight(insights.borough_means),
        "year_range": year_range,
        "numeric_profile": _profiled(_clean, profile.CLEAN_NUMBERS),
        "numeric_profile_raw": _profiled(_raw, profile.RAW_NUMBERS),
        "row_preview": lambda s, d: profile.preview(_clean(s, d)),
        "clean_basic": _basic,
        "clean_strict": _clean,
        "rule_attrition": lambda s, d: quality.attrition(quality.with_duration(quality.fill_defaults(_raw(s, d)))),
        "fill_defaults": lambda s, d: quality.fill_defaults(_raw(s, d)),
        "duration_feature": lambda s, d: quality.with_duration(_raw(s, d)).select(
            "pickup_datetime", "dropoff_datetime", "trip_duration_mins"
        ),
        "elapsed_duration": lambda s, d: quality.with_duration(_raw(s, d), "America/New_York").select(
            "pickup_datetime", "dropoff_datetime", "trip_duration_mins"
        ),
        "enriched": lambda s, d: enrich(_clean(s, d)),
        "zone_join_merge": _joined("merge"),
        "zone_join_broadcast": _joined("broadcast"),
        "standardized_union": standardized_union,
        "drifting_union": drifting_union,
        "one_file_standardized": one_file_standardized,
        "written_report": written_report,
        "schema_drift": schema_drift,
        "partitioned_roundtrip": lambda s, d: sources.read_clean(s, _written(s, d)),
        "pruned_year_month": lambda s, d: sources.read_clean(s, _written(s, d), (2012, 2013), (3, 4, 11)),
        "compact_roundtrip": compact_roundtrip,
        "coalesced_write": coalesced_write,
        "replaced_month": replaced_month,
        "bucketed_counts": bucketed_counts,
        "zones_from_csv": zones_from_csv,
        "trip_rollup": lambda s, d: _settled(rollup(_clean(s, d))),
        "borough_stats_rollup": _from_rollup(insights.borough_stats),
        "yearly_trends_rollup": _from_rollup(insights.yearly_trends),
        "weekend_comparison_rollup": _from_rollup(insights.weekend_comparison),
        **{
            f"passengers_by_{key.removeprefix('pickup_')}_rollup": _from_rollup(
                insights.Insight("passengers", (key,), (insights.mean("passenger_count", "avg_passengers"),))
            )
            for key in ("pickup_year", "pickup_month", "pickup_hour", "pickup_day_of_week")
        },
        "route_labels": lambda s, d: report.with_route_labels(insights.top_routes(_clean(s, d), None)),
        "hour_labels": hour_labels,
        "weekend_share": lambda s, d: report.with_share(insights.weekend_comparison(_clean(s, d))).select(
            "is_weekend", "trip_count", "share_pct"
        ),
        "formatted_counts": lambda s, d: report.formatted(
            insights.borough_stats(_clean(s, d)).select("pickup_borough", "trip_count", "total_revenue")
        ),
        "month_coverage": lambda s, d: audit.month_coverage(audit.observed_months(_clean(s, d))),
        "missing_months": lambda s, d: audit.missing_months(audit.observed_months(_clean(s, d))),
        "latency_stats": _latency(),
        "latency_narrowed": _latency(direct_limit=500),
        "latency_overall": _latency(by=()),
        "tail_class": tail_class,
        "latency_slowest": _slowest(("event_type",)),
        "slowest_overall": _slowest(()),
        "skip_damaged": skip_damaged,
        "eras_by_name": eras_by_name,
        "ingest_remainder": ingest_remainder,
        "schema_runs_by_month": schema_runs_by_month,
        "incremental_months": incremental_months,
        "streamed_batches": streamed_batches,
        "streamed_clean": streamed_clean,
        "streamed_hourly_counts": streamed_hourly_counts,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query.

    ``schema_drift`` gives the paths of scratch files and has none.
    """
    statements = oracles.statements() | (llm.oracle_sql() if llm else {})
    if llm and corpus_pipeline.ORACLE_SQL:
        statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
