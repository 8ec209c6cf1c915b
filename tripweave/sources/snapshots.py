"""Small tables kept in versions, so that readers see one state or the next and never half of one.

A version is a folder ``v=N`` that counts once Spark's committer has put its ``_SUCCESS`` there,
which is the last thing a write does. A writer that loses the race for a number fails; what a crash
left behind is never read, and the next commit removes it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEEP = 2  # versions left for readers that have just looked the last one up


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _folder(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; a folder that is not there is empty."""
    system, target = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    system, target = _folder(spark, path)
    return system.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    system, target = _folder(spark, path)
    system.delete(target, True)


def make(spark: SparkSession, path: str) -> None:
    system, target = _folder(spark, path)
    system.mkdirs(target)


def rename(spark: SparkSession, path: str, new: str) -> None:
    system, target = _folder(spark, path)
    if not system.rename(target, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {path} to {new}")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = (re.fullmatch(r"v=(\d+)", name) for name in children(spark, path))
    return sorted(int(m[1]) for m in found if m)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, oldest first."""
    return [n for n in _numbers(spark, path) if exists(spark, f"{path}/v={n}/_SUCCESS")]


def commit(frame: DataFrame, path: str, keep: int = KEEP) -> int:
    """Write the next version; returns its number. Versions before the last ``keep`` go."""
    spark = frame.sparkSession
    number = max(_numbers(spark, path), default=-1) + 1
    frame.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/v={number}")
    stay = versions(spark, path)[-keep:]
    for old in _numbers(spark, path):
        if old < number and old not in stay:
            remove(spark, f"{path}/v={old}")
    return number


def read(spark: SparkSession, path: str, schema: StructType | str, version: int | None = None) -> DataFrame:
    """A version, the last one by default; without any, an empty frame."""
    if version is None:
        version = max(versions(spark, path), default=None)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={version}")
