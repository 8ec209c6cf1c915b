"""Reader for the zone lookup file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.schemas import ZONE_SCHEMA


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone CSV with a header row; the given schema spares an inference job."""
    return spark.read.schema(ZONE_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)
