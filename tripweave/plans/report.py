"""Run insights, write each result and time the runs."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tripweave.functions import labels, ratios
from tripweave.operators.latency import latency_stats, slowest, tail_class
from tripweave.plans.insights import INSIGHTS, Insight
from tripweave.plans.rollup import rollup


class Report(NamedTuple):
    """What writing a report took: ``name, value, parallel`` of every insight, and the shared read apart."""

    timings: DataFrame
    shared_seconds: float


def write_report(
    trips: DataFrame,
    path: str,
    insights: Sequence[Insight] = INSIGHTS,
    digits: int | None = 2,
    shared_pass: bool = True,
    fmt: str = "parquet",
    parallel: int = 4,
) -> Report:
    """Write every insight under ``path/insight=<name>`` and time each.

    With ``shared_pass`` the trips are read once into a rollup table, ``path/_rollup``,
    and the insights are computed from that. ``parallel`` jobs are submitted at a time,
    since each is too small to fill a cluster; a time then holds waits for the others, so
    use 1 where the latencies themselves are of interest.
    """
    spark, shared_seconds = trips.sparkSession, 0.0
    source = trips
    if shared_pass:
        begun = time.perf_counter()
        rollup(trips).write.mode("overwrite").parquet(f"{path}/_rollup")
        source = spark.read.parquet(f"{path}/_rollup")
        shared_seconds = time.perf_counter() - begun

    def save(insight: Insight) -> tuple[str, float, int]:
        begun = time.perf_counter()
        writer = insight(source, digits).write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{path}/insight={insight.name}")
        return insight.name, time.perf_counter() - begun, parallel

    with ThreadPoolExecutor(parallel) as pool:
        timings = list(pool.map(save, insights))
    return Report(spark.createDataFrame(timings, "name string, value double, parallel int"), shared_seconds)


def timing_summary(timings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latency statistics with their tail class, and the three slowest queries."""
    return tail_class(latency_stats(timings)), slowest(timings, 3)


def formatted(result: DataFrame, digits: int = 2) -> DataFrame:
    """Every number as thousands-separated text, for presentation."""

    def text(field) -> Column:
        if isinstance(field.dataType, NumericType):
            return labels.number_text(F.col(field.name), digits).alias(field.name)
        return F.col(field.name)

    return result.select(*[text(field) for field in result.schema.fields])


def with_route_labels(routes: DataFrame, million_digits: int = 1) -> DataFrame:
    """Routes by ascending volume, with a route label and a short count label."""
    return routes.withColumns(
        {
            "route_label": labels.route_label(F.col("pickup_borough"), F.col("dropoff_borough")),
            "count_label": labels.magnitude_label(F.col("trip_count"), million_digits),
        }
    ).orderBy("trip_count", "route_label")


def with_share(result: DataFrame, digits: int = 1) -> DataFrame:
    """Each row's share of all trips, in percent. For aggregated results only."""
    whole = F.sum("trip_count").over(W.partitionBy())
    return result.withColumn("share_pct", ratios.share_percent(F.col("trip_count"), whole, digits))
