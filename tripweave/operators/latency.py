"""Latency statistics over (name, seconds) samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.operators.ranks import bracketed, floor_index, group_facts, order_statistics

PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
HIGH_TAIL, MODERATE_TAIL = 3.0, 2.0


def latency_stats(
    samples: DataFrame,
    value: str = "value",
    by: Sequence[str] = (),
    percentiles: Mapping[str, float] = PERCENTILES,
    direct_limit: int | None = None,
) -> DataFrame:
    """``samples, min_value, max_value, mean_value`` and the percentiles, per group.

    A percentile is the sorted value at 0-based index ``floor(n * p)``. Without groups an
    empty input gives one row of zeros. By default sketches bracket the percentiles and one more
    pass counts them out, in a plan that runs nothing while it is built. With ``direct_limit`` histogram
    passes narrow them down until so many distinct values are left: for groups of which even a hundredth is
    too much to order in one task.
    """
    picks = {name: floor_index(p) for name, p in percentiles.items()}
    named = {"size": "samples", "lo": "min_value", "hi": "max_value", "mean": "mean_value"}
    if direct_limit is None:
        whole = bracketed(samples, [value], picks, by).withColumnRenamed(value, "of")
        stats = whole.select("key", *[F.col(f"of.{old}").alias(new) for old, new in named.items()], *[F.col(f"of.{p}") for p in picks])
        stats = stats.where("samples > 0")
    else:
        groups = group_facts(samples, value, by)
        ranked = (
            order_statistics(samples, value, picks, by, direct_limit, facts=groups)
            .groupBy("key")
            .agg(*[F.max(F.when(F.col("pick") == name, F.col("value"))).alias(name) for name in picks])
            .withColumnRenamed("key", "rank_key")
        )
        totals = groups.select("key", *[F.col(old).alias(new) for old, new in named.items()])
        stats = totals.join(ranked, F.col("key") == F.col("rank_key"), "left").drop("rank_key")
    if not by:  # a row of zeros stands for no samples at all
        one = samples.sparkSession.range(1).select(F.struct(F.lit(0).alias("_all")).alias("only"))
        stats = one.join(stats, F.col("only") == F.col("key"), "left")
        stats = stats.withColumn("samples", F.coalesce("samples", F.lit(0).cast("long")))
    numbers = ["min_value", "max_value", "mean_value", *picks]
    return stats.select(
        *[F.col("key")[name].alias(name) for name in by], "samples", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in numbers]
    )


def tail_class(stats: DataFrame) -> DataFrame:
    """Add ``tail_ratio`` (p99 over p50, 0 without a positive p50) and ``tail_class``."""
    ratio = F.when(F.col("p50") > 0, F.col("p99") / F.col("p50")).otherwise(F.lit(0.0))
    label = (
        F.when(F.col("tail_ratio") > HIGH_TAIL, "high")
        .when(F.col("tail_ratio") > MODERATE_TAIL, "moderate")
        .otherwise("good")
    )
    return stats.withColumn("tail_ratio", ratio).withColumn("tail_class", label)


def slowest(
    samples: DataFrame,
    k: int = 3,
    value: str = "value",
    by: Sequence[str] = (),
    ties: Sequence[str] = ("name",),
) -> DataFrame:
    """The ``k`` largest values, overall or per group, ties in order of ``ties``.

    The rank filter is applied in every task before the shuffle, so a large group sends
    at most ``k`` rows from each.
    """
    order = [F.desc(value), *[F.asc(t) for t in ties]]
    if not by:
        return samples.orderBy(*order).limit(k)
    position = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return samples.withColumn("position", position).filter(F.col("position") <= k)
