"""Time the jobs and queries; prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query, the median counts (default 3)
BENCH_COPIES   shifted copies of the raw trips (default 40: 24 million at sf 0.1); with 1, start-up costs dominate

The raw files hold about a month each. Times include building the plan, which is also
measured on other hardware and 60 times as many rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripweave import fixtures  # noqa: E402
from tripweave.operators import audit, latency, profile, quality  # noqa: E402
from tripweave.plans import insights, report  # noqa: E402
from tripweave.plans.etl import clean_trips, clean_trips_basic  # noqa: E402
from tripweave.session import build_session, scratch_path  # noqa: E402
from tripweave.sources import trips as sources  # noqa: E402
from tripweave.sources import writers  # noqa: E402
from tripweave.sources.zones import read_zones  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "40"))


RECORDED = {"etl_basic": 1438.3e6 / 1950.37, "etl_strict": 1438.3e6 / 1151.76, "twelve_insights": 12 * 1343.8e6 / 587.59}
MONTHS = 96  # tasks to which the months of the raw trips are dealt


def shifted_copies(trips: DataFrame, copies: int) -> DataFrame:
    """Each trip ``copies`` times, some minutes apart and with different amounts."""
    shift = F.col("copy")
    later = {c: F.timestamp_add("MINUTE", shift * 17, F.col(c)) for c in ("pickup_datetime", "dropoff_datetime")}
    amounts = {"total_amount": F.col("total_amount") + shift % 40 * 0.25}
    return trips.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumns(
        later | amounts
    ).drop("copy")


def timed(run: Callable[[], object], repeats: int = REPEATS) -> float:
    spent = []
    for _ in range(repeats):
        begun = time.perf_counter()
        run()
        spent.append(time.perf_counter() - begun)
    return statistics.median(spent)


def measure(runs: dict[str, Callable[[], object]]) -> dict[str, float]:
    seconds = {}
    for name, run in runs.items():
        if COPIES == 1:
            run()  # warm-up
        seconds[name] = round(timed(run), 4)
        print(f"{name} {seconds[name]:.3f}", file=sys.stderr)
    return seconds


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = scratch_path(spark, "bench")

    # Input preparation, not timed: raw files as the three eras stored them.
    trips = fixtures.order_trips(spark, FOLDER)
    if COPIES > 1:
        trips = shifted_copies(trips.repartition(int(CPUS) * 4), COPIES)
    trips.repartition(int(CPUS)).write.parquet(f"{work}/all")
    by_month = spark.read.parquet(f"{work}/all").repartition(MONTHS, F.trunc("pickup_datetime", "MM"))
    fixtures.write_era_folders(by_month, f"{work}/raw")
    zones_frame = fixtures.nation_zones(spark, FOLDER)
    zones_frame.coalesce(1).write.option("header", True).csv(f"{work}/zones")
    eras = list(fixtures.era_folders(f"{work}/raw").values())

    def raw() -> DataFrame:
        return sources.union_standard([sources.read_era(spark, era, path) for era, path in eras])

    def zones() -> DataFrame:
        return read_zones(spark, f"{work}/zones")

    clean_path = f"{work}/clean"
    jobs: dict[str, Callable[[], object]] = {
        "etl_basic": lambda: writers.write_compact(clean_trips_basic(raw(), zones()), f"{work}/basic"),
        "etl_strict": lambda: writers.write_clean(clean_trips(raw(), zones()), clean_path),
        "etl_strict_map_only": lambda: writers.write_clean(
            clean_trips(raw(), zones()), f"{work}/clean-map-only", shuffle=False
        ),
    }
    seconds = measure(jobs)

    clean = sources.read_clean(spark, clean_path)
    queries: dict[str, Callable[[], object]] = {
        i.name: (lambda i=i: i(clean).collect()) for i in insights.INSIGHTS
    }
    extras: dict[str, Callable[[], object]] = {
        "all_insights_one_pass": lambda: report.write_report(clean, f"{work}/report"),
        "rule_attrition": lambda: quality.attrition(quality.with_duration(quality.fill_defaults(raw()))).collect(),
        "numeric_profile": lambda: profile.numeric_profile(clean).collect(),
        "month_coverage": lambda: audit.month_coverage(audit.observed_months(clean)).collect(),
        "schema_runs": lambda: audit.schema_runs(sources.list_files(spark, f"{work}/raw", "*.parquet")).collect(),
        "latency_stats": lambda: latency.latency_stats(
            spark.read.parquet(f"{FOLDER}/events.parquet"), by=("event_type",)
        ).collect(),
    }
    seconds |= measure({**queries, **extras})

    builds = sum(timed(lambda i=i: i(clean)) for i in insights.INSIGHTS)
    raw_rows, clean_rows = raw().count(), clean.count()
    scans = sum(seconds[i.name] for i in insights.INSIGHTS)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "copies": COPIES,
                "raw_rows": raw_rows,
                "clean_rows": clean_rows,
                "plan_build_sec": {"twelve_insights": round(builds, 4)},
                "recorded_rows_per_sec": {name: round(rate) for name, rate in RECORDED.items()},
                "rows_per_sec": {
                    "etl_basic": round(raw_rows / seconds["etl_basic"]),
                    "etl_strict": round(raw_rows / seconds["etl_strict"]),
                    "twelve_insights": round(12 * clean_rows / scans),
                },
            }
        )
    )


if __name__ == "__main__":
    main()
