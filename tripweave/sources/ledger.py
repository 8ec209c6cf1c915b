"""What is known of every raw file, kept from run to run.

A ledger is a versioned table with a row for each file: what the listing says (``path, length,
modified``), the month and era by its name, and what its footer says (``schema, verdict, error``). A run lists the files, keeps the rows of those that
the listing shows unchanged, and opens the footers of the others only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.audit import DAMAGED, file_schemas
from tripweave.schemas import ERAS, Era
from tripweave.session import written
from tripweave.sources import snapshots
from tripweave.sources.trips import PREFIX, file_era, file_month, list_files

LEDGER_DDL = (
    "path string, length long, modified timestamp, month string, era string, schema string, schema_hash long, "
    "verdict string, error string"
)
COLUMNS = [column.split(" ")[0] for column in LEDGER_DDL.split(", ")]
SEEN = ["path", "length", "modified"]


def entries(spark: SparkSession, ledger: str, version: int | None = None) -> DataFrame:
    """The rows of a ledger, of its last version by default."""
    return snapshots.read(spark, ledger, LEDGER_DDL, version)


def compared(listing: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``known`` that the listing shows unchanged, and the listed files that are new or another."""
    seen = known.select(*SEEN)
    return known.join(listing.select(*SEEN), SEEN, "left_semi"), listing.join(seen, SEEN, "left_anti")


def update(
    spark: SparkSession,
    path: str,
    ledger: str,
    pattern: str = "*.parquet",
    eras: Iterable[Era] = ERAS,
    prefix: str = PREFIX,
) -> DataFrame:
    """Bring the ledger up to the files under ``path``; returns its rows. A run that finds no change writes none."""
    listing = list_files(spark, path, pattern)
    listing = listing if "tail" in listing.columns else written(listing, "listing")
    known = entries(spark, ledger)
    same, new = compared(listing, known)
    opened = file_schemas(new).join(new.select(*SEEN), "path")
    opened = opened.withColumns(
        {
            "month": F.nullif(file_month(prefix), F.lit("")),
            "era": file_era(eras, prefix),
            "schema_hash": F.xxhash64("schema"),
        }
    )
    opened = written(opened.select(*COLUMNS), "opened")
    if opened.isEmpty() and snapshots.versions(spark, ledger) and same.count() == known.count():
        return known
    snapshots.commit(same.select(*COLUMNS).unionByName(opened), ledger)
    return entries(spark, ledger)


def remainder(known: DataFrame) -> DataFrame:
    """``path`` and ``reason`` of the files that no era takes or that are damaged."""
    reason = F.when(F.col("verdict") == DAMAGED, "damaged").when(F.col("month").isNull(), "not named by a month")
    reason = reason.when(F.col("era").isNull(), "a month of no era")
    return known.select("path", reason.alias("reason")).where("reason IS NOT NULL")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``path, change`` (added, changed or removed) from one state of a ledger or listing to another."""
    old = before.select(F.col("path").alias("old"), F.struct(*SEEN[1:]).alias("was"))
    new = after.select("path", F.struct(*SEEN[1:]).alias("is"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("path").isNull(), "removed")
    change = change.when(~F.col("was").eqNullSafe(F.col("is")), "changed")
    both = new.join(old, F.col("path") == F.col("old"), "full")
    return both.select(F.coalesce("path", "old").alias("path"), change.alias("change")).where("change IS NOT NULL")
