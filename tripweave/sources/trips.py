"""Readers for raw trip files and for the cleaned table."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.operators.audit import OPENED_IN_TASKS, file_schemas, unreadable_files
from tripweave.operators.standardize import standard_column, standardize, union_standard
from tripweave.schemas import CLEAN_SCHEMA, ERAS, PARTITION_SCHEMA, TARGETS, Era
from tripweave.session import case_sensitive, written

PREFIX = "yellow_tripdata_"
ANY_MONTH = PREFIX + "[0-9][0-9][0-9][0-9]-*.parquet"
YEAR = "(?<![0-9])[0-9]{4}"
FETCHED_TAIL = 8 << 20  # bytes that Spark brings of a file which tasks cannot open; footers are smaller
ALIASES = frozenset(alias for target in TARGETS for alias in target.aliases)


def list_files(spark: SparkSession, path: str, pattern: str = ANY_MONTH) -> DataFrame:
    """``path``, ``length`` and ``modified`` of the matching files, in path order; none is an error.

    In a file system that only Spark can open, ``tail`` holds the last bytes of each, which
    Spark fetches when they are asked for.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"), "content")
    )
    if re.match(OPENED_IN_TASKS, path):
        found = found.drop("content")
    else:
        found = found.withColumn("tail", F.expr(f"substring(content, -{FETCHED_TAIL}, {FETCHED_TAIL})")).drop("content")
    if found.drop("tail").isEmpty():
        raise FileNotFoundError(f"no files like {pattern} under {path}")
    return found.orderBy("path")


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One file (or one folder of like files), schema from its footer, standardized."""
    return standardize(case_sensitive(spark).read.parquet(path))


def read_era(
    spark: SparkSession, era: Era, *paths: str, pattern: str | None = None, skip_unreadable: bool = False
) -> DataFrame:
    """The files of one era in a single scan, standardized.

    The era's schema is given to the reader, so no footer is opened up front and a column
    a file lacks reads as null. ``pattern`` restricts the file names. By default a damaged
    or vanished file fails the job; ``skip_unreadable`` goes on without it
    (``unreadable_files`` names the damaged ones).
    """
    reader = case_sensitive(spark).read.schema(era.schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return standardize(reader.parquet(*paths))


def read_eras(
    spark: SparkSession,
    path: str,
    eras: Iterable[Era] = ERAS,
    prefix: str = PREFIX,
    skip_unreadable: bool = False,
) -> DataFrame:
    """All monthly files under ``path``, one scan per era, assigned by file name.

    ``left_out`` names the files that no era takes.
    """
    scans = [
        read_era(spark, era, path, pattern=era.name_pattern(prefix), skip_unreadable=skip_unreadable) for era in eras
    ]
    return union_standard(scans)


def left_out(spark: SparkSession, path: str, eras: Iterable[Era] = ERAS, prefix: str = PREFIX) -> DataFrame:
    """``path`` and ``reason`` of every Parquet file that ``read_eras`` does not read, or that is damaged.

    With ``read_eras`` this accounts for all files under a folder: a file of a month
    outside every era, or not named by a month, is listed here and not read.
    """
    files = list_files(spark, path, "*.parquet")
    damaged = unreadable_files(file_schemas(files)).select("path", F.col("error").alias("reason"))
    return unassigned(files, eras, prefix).unionByName(damaged)


def file_era(eras: Iterable[Era] = ERAS, prefix: str = PREFIX) -> Column:
    """The name of the era that takes the file ``path``, null where none does."""
    month = file_month(prefix)
    chain = F.lit(None).cast("string")
    for era in reversed(tuple(eras)):
        chain = F.when(month.between("%04d-%02d" % era.first, "%04d-%02d" % era.last), era.name).otherwise(chain)
    return chain


def file_month(prefix: str = PREFIX) -> Column:
    """The ``YYYY-MM`` by which the file ``path`` is named, empty if it is not."""
    return F.regexp_extract("path", f"/{re.escape(prefix)}(\\d{{4}}-\\d{{2}})\\.parquet$", 1)


def unassigned(files: DataFrame, eras: Iterable[Era] = ERAS, prefix: str = PREFIX) -> DataFrame:
    """``path`` and ``reason`` of the files that no era takes."""
    reason = F.when(file_month(prefix) == "", "not named by a month")
    reason = reason.when(file_era(eras, prefix).isNull(), "a month of no era")
    return files.select("path", reason.alias("reason")).where("reason IS NOT NULL")


def read_drifting(spark: SparkSession, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Standardized trips from files of unknown schemas, and the files left out.

    Footers are read on the executors, unless ``files`` are the entries of a ledger, which
    knows the schemas; the trips are then scanned once per distinct schema. The driver gets one
    row for each folder of files with one schema. Of a mixed folder it gets, for each schema, the
    years, months and, only where a month itself is mixed, the files. A file that is damaged is
    skipped and listed in the second frame (``path, error``); a file that cannot be
    fetched fails the job; nothing readable at all is an error.
    """
    known = files if "verdict" in files.columns else written(file_schemas(files), "footers")
    frames = [standardize(scan) for scan in raw_scans(spark, known)]
    if not frames:
        raise FileNotFoundError("no readable trip file")
    return union_standard(frames), unreadable_files(known)


def raw_scans(spark: SparkSession, known: DataFrame) -> list[DataFrame]:
    """The files of ``known`` (``path, schema``) as they are, a frame for each schema and folder."""
    session, scans = case_sensitive(spark), []
    for row in scan_groups(known).orderBy("schema", "folder").collect():
        schema = _known_columns(row["schema"])

        def scan(names: Sequence[str]) -> DataFrame:
            reader = session.read.schema(schema)
            return (reader.option("pathGlobFilter", _glob(names)) if names else reader).parquet(row["folder"])

        found = scan(row["names"])
        if len(found._jdf.inputFiles()) != row["files"]:  # the folder holds more files of such names than were listed
            own = known.where((F.col("schema") == row["schema"]) & (_folder() == row["folder"]))
            found = scan([r["name"] for r in own.select(_name().alias("name")).collect()])
        scans.append(found)
    return scans


def months_fed(spark: SparkSession, known: DataFrame) -> DataFrame:
    """``path, fed``: the months (``YYYY-MM``) in which the trips of each file begin, sorted."""
    pickup = next(t for t in TARGETS if t.name == "pickup_datetime")
    parts = [
        scan.select(F.col("_metadata.file_path").alias("path"), standard_column(pickup, set(scan.columns)))
        for scan in raw_scans(spark, known)
    ]
    if not parts:
        return spark.createDataFrame([], "path string, fed array<string>")
    months = F.date_format("pickup_datetime", "yyyy-MM")
    found = reduce(DataFrame.unionByName, parts).select(_place(F.col("path"), True).alias("place"), months.alias("month"))
    fed = found.groupBy("place").agg(F.sort_array(F.collect_set("month")).alias("fed"))
    listed = known.select("path", _place(F.col("path"), False).alias("place"))
    return listed.join(fed, "place").select("path", "fed")


def _place(path: Column, encoded: bool) -> Column:
    """A path in one spelling: scans write it as an address, with other slashes and escapes than listings do."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path
    return F.regexp_replace(plain, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def scan_groups(known: DataFrame) -> DataFrame:
    """``schema, folder, names, files``: what one scan takes of a folder, and by which names (all, if null).

    A file is told by its folder if all files there have one schema, else by the year in its
    name if all of that year have, else by its month, else by its whole name. Damaged files count as a schema
    of their own, which no group has.
    """
    parts = known.select(_folder().alias("folder"), _name().alias("name"), F.coalesce("schema", F.lit("")).alias("schema"))
    stems = {"all": F.lit(""), "year": _stem(YEAR), "month": _stem(YEAR + "-[0-9]{2}")}
    start = F.col("name")
    for level, stem in reversed(stems.items()):
        parts = parts.withColumn(level, stem)
        same = parts.groupBy("folder", level).agg((F.min("schema") == F.max("schema")).alias(f"one_{level}"))
        parts = parts.join(same, ["folder", level])
        told = F.col(f"one_{level}") & (F.lit(level == "all") | (F.col(level) != ""))
        start = F.when(told, F.concat(level, F.lit("*"))).otherwise(start)
    starts = parts.where("schema <> ''").withColumn("start", start)
    return starts.groupBy("schema", "folder").agg(
        F.sort_array(F.collect_set(F.nullif("start", F.lit("*")))).alias("names"), F.count("*").alias("files")
    )


def _folder() -> Column:
    return F.regexp_extract("path", "^(.*)/[^/]*$", 1)


def _name() -> Column:
    return F.regexp_extract("path", "/([^/]*)$", 1)


def _stem(digits: str) -> Column:
    return F.regexp_extract("name", f"^(.*?{digits})", 1)


def _glob(names: Sequence[str]) -> str:
    """A pattern that matches the names; only a star at the end of one keeps its meaning."""
    safe = [re.sub(r"([\\{}\[\]?*,])", r"\\\1", n.removesuffix("*")) + "*" * n.endswith("*") for n in names]
    return "{" + ",".join(safe) + "}"


def _known_columns(ddl: str) -> StructType:
    return StructType([field for field in StructType.fromDDL(ddl).fields if field.name in ALIASES])


def read_clean(
    spark: SparkSession,
    path: str,
    years: tuple[int, int] | None = None,
    months: Sequence[int] | None = None,
) -> DataFrame:
    """The cleaned table, restricted to partitions of a span of years and some months.

    Both filters are on the partition columns, so other directories are never listed
    for reading. The schema is known and not inferred.
    """
    table = spark.read.schema(StructType(CLEAN_SCHEMA.fields + PARTITION_SCHEMA.fields)).parquet(path)
    if years is not None:
        table = table.filter(F.col("year").between(*years))
    if months is not None:
        table = table.filter(F.col("month").isin(*months))
    return table
