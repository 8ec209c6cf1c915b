"""Loading only the months that changed.

A table keeps its months in folders of loads, ``data/load=N/year=Y/month=M``, and a versioned state
next to them: which load each month is read from, and which files the table was made of, with the
months each of them fed. A run asks the ledger what changed since, works out the months that
changed files feed or fed, reads all files that feed one of these, and writes those months to a load of their
own. Committing the state is the swap: readers see all months of the new state or none. Loads that no
kept state refers to are removed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.operators.audit import SOUND
from tripweave.plans.etl import clean_trips
from tripweave.schemas import CLEAN_SCHEMA, ERAS, PARTITION_SCHEMA, Era
from tripweave.session import written
from tripweave.sources import ledger as ledgers
from tripweave.sources import snapshots
from tripweave.sources.trips import PREFIX, months_fed, read_drifting
from tripweave.sources.writers import write_clean

STATE_DDL = "kind string, month string, load long, path string, length long, modified timestamp, fed array<string>"
MONTH, FILE = "month", "file"


def state(spark: SparkSession, table: str) -> DataFrame:
    """What the table is made of: a row for each month and each file."""
    return snapshots.read(spark, f"{table}/state", STATE_DDL)


def read_table(
    spark: SparkSession, table: str, years: tuple[int, int] | None = None, months: Sequence[int] | None = None
) -> DataFrame:
    """The cleaned trips with ``year`` and ``month``. Folders of other months are not even listed."""
    schema = StructType(CLEAN_SCHEMA.fields + PARTITION_SCHEMA.fields)
    wanted = []
    for row in state(spark, table).where(F.col("kind") == MONTH).orderBy("month").collect():  # bounded by the calendar
        year, month = map(int, row["month"].split("-"))
        if (years is None or years[0] <= year <= years[1]) and (months is None or month in months):
            wanted.append(f"{table}/data/load={row['load']}/year={year}/month={month}")
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{table}/data").parquet(*wanted).select(*schema.names)


def load_changes(
    spark: SparkSession,
    raw: str,
    zones: DataFrame,
    table: str,
    ledger: str,
    pattern: str = "*.parquet",
    eras: Iterable[Era] = ERAS,
    prefix: str = PREFIX,
    **cleaning: object,
) -> list[str]:
    """Bring the table up to the files under ``raw``; returns the months written or dropped.

    Sound files of an era's month take part. A run without changes writes nothing. ``cleaning``
    goes to ``clean_trips``.
    """
    known = ledgers.update(spark, raw, ledger, pattern, eras, prefix)
    known = known.where((F.col("verdict") == SOUND) & F.col("era").isNotNull())
    before = state(spark, table)
    loaded = before.where(F.col("kind") == FILE)
    change = written(ledgers.changes(loaded, known), "changes")
    new = known.join(change.where("change <> 'removed'"), "path", "left_semi")
    gone = loaded.join(change, "path", "left_semi")
    same = loaded.join(change, "path", "left_anti").select("path", "length", "modified", "fed")
    # a file that holds no trip feeds no month, but has been seen
    fed = new.select("path", "length", "modified").join(months_fed(spark, new), "path", "left")
    fed = fed.withColumn("fed", F.coalesce("fed", F.array().cast("array<string>")))
    fed = written(fed, "fed")
    touched = gone.select(F.explode("fed").alias("month")).unionByName(fed.select(F.explode("fed").alias("month")))
    affected = sorted(r["month"] for r in touched.distinct().collect())  # bounded by the calendar
    if not affected and change.isEmpty():
        return []
    files = written(same.unionByName(fed.select("path", "length", "modified", "fed")), "files")
    load = _next_load(spark, table)
    target = f"{table}/data/load={load}"
    needed = files.where(F.arrays_overlap("fed", F.array(*map(F.lit, affected)))) if affected else files.limit(0)
    sources = known.join(needed, "path", "left_semi")
    if not sources.isEmpty():
        trips, _ = read_drifting(spark, sources)
        trips = trips.where(F.date_format("pickup_datetime", "yyyy-MM").isin(affected))
        write_clean(clean_trips(trips, zones, **cleaning), target)
    kept = before.where((F.col("kind") == MONTH) & ~F.col("month").isin(affected)).select("month", "load")
    months = kept.unionByName(
        spark.createDataFrame([(m, load) for m in _written_months(spark, target)], "month string, load long")
    )
    rows = months.select(F.lit(MONTH).alias("kind"), "month", "load").unionByName(
        files.select(F.lit(FILE).alias("kind"), "path", "length", "modified", "fed"), allowMissingColumns=True
    )
    snapshots.commit(rows.select(*[c.split(" ")[0] for c in STATE_DDL.split(", ")]).coalesce(1), f"{table}/state")
    _drop_loads(spark, table)
    return affected


def _next_load(spark: SparkSession, table: str) -> int:
    found = [int(n.removeprefix("load=")) for n in snapshots.children(spark, f"{table}/data") if n.startswith("load=")]
    return max(found, default=-1) + 1


def _written_months(spark: SparkSession, load: str) -> list[str]:
    """The months that a load has folders for."""
    months = []
    for year in snapshots.children(spark, load):
        for month in snapshots.children(spark, f"{load}/{year}") if year.startswith("year=") else ():
            if month.startswith("month="):
                months.append(f"{int(year.removeprefix('year=')):04d}-{int(month.removeprefix('month=')):02d}")
    return months


def _drop_loads(spark: SparkSession, table: str) -> None:
    """Remove loads that no kept state reads from. What a load under way writes is newer than all of them."""
    kept = set()
    for version in snapshots.versions(spark, f"{table}/state"):
        rows = snapshots.read(spark, f"{table}/state", STATE_DDL, version).where(F.col("kind") == MONTH)
        kept |= {r["load"] for r in rows.select("load").distinct().collect()}
    for name in snapshots.children(spark, f"{table}/data"):
        number = int(name.removeprefix("load="))
        if number not in kept and number < max(kept, default=0):
            snapshots.remove(spark, f"{table}/data/{name}")
