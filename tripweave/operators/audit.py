"""Schema-drift and month-coverage audits."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.schemas import FIRST_YEAR, LAST_YEAR
from tripweave.session import written

FOOTER_DDL = "path string, schema string, verdict string, error string"
# Executors need not have this package: the task functions below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_DDL = "stretch int, place long, first_file string, last_file string, files long, schema string"
TAIL_BYTES = 1 << 16  # of a file read first; a longer footer takes a second read
ATTEMPTS = 4
SOUND, DAMAGED, UNREACHABLE, REFUSED = "sound", "damaged", "unreachable", "refused"
# File systems that tasks open themselves. Of files elsewhere Spark's reader fetches the bytes.
OPENED_IN_TASKS = r"^(file:|s3:|s3a:|gs:|/)"


class FileUnreachable(Exception):
    """A file whose bytes could not be fetched, after several attempts."""


class FileRefused(FileUnreachable):
    """A file that the caller may not read."""


class DamagedFile(Exception):
    """A file that is not, or no longer, a Parquet file."""


def _opened(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    if "://" in path:
        system, name = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return system.open_input_file(name)
    return pafs.LocalFileSystem().open_input_file(path)


def _tail(path: str, size: int, open_file=None) -> tuple[bytes, int]:
    """The last bytes of a file and its length; only input errors can happen here."""
    with (open_file or _opened)(path) as handle:
        length = handle.size()
        start = max(0, length - size)
        handle.seek(start)
        data = handle.read(length - start)
        if len(data) != length - start:
            raise OSError(f"{len(data)} of {length - start} bytes came")
        return data, length


def _fetched(path: str, size: int, open_file=None, wait: float = 0.2) -> tuple[bytes, int]:
    """``_tail`` with retries. A store's refusal is told apart from a connection that failed."""
    import time

    for attempt in range(ATTEMPTS):
        try:
            return _tail(path, size, open_file)
        except PermissionError as problem:
            raise FileRefused(f"{path}: {problem}") from problem
        except OSError as problem:
            told = str(problem).upper()
            if any(word in told for word in ("ACCESS_DENIED", "ACCESS DENIED", "ACCESSDENIED", "FORBIDDEN", "HTTP STATUS 403")):
                raise FileRefused(f"{path}: {problem}") from problem
            if attempt + 1 == ATTEMPTS:
                raise FileUnreachable(f"{path}: {type(problem).__name__}: {problem}") from problem
            time.sleep(wait * 2**attempt)


def _footer_size(data: bytes, length: int) -> int:
    """Bytes from the start of the footer to the file's end."""
    if length < 12 or data[-4:] != b"PAR1":
        return len(data)  # parsing them tells what they are not
    size = int.from_bytes(data[-8:-4], "little") + 8
    if size + 4 > length:
        raise DamagedFile("the footer is longer than the file")
    return size


def _schema_of(data: bytes) -> str:
    """Schema as Spark DDL from the bytes of a footer, which are all there: what fails here is damage.

    A column without a type (all null when it was written) is an int, as Spark reads it.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    # Spark's types for what it reads wider or differently than the Arrow type says.
    wider = {pa.null(): "int", pa.uint8(): "smallint", pa.uint16(): "int", pa.uint32(): "bigint"}
    wider[pa.uint64()] = "decimal(20,0)"
    try:
        file = pq.ParquetFile(pa.BufferReader(data))
        fields = file.schema_arrow
        leaves = [file.schema.column(i) for i in range(len(file.schema))]
    except (OSError, pa.ArrowException) as problem:
        raise DamagedFile(f"{type(problem).__name__}: {problem}") from problem
    int96 = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
    columns = []
    for field in fields:
        if field.name in int96:
            kind = "timestamp"
        else:
            kind = wider.get(field.type) or from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
        columns.append(f"`{field.name.replace('`', '``')}` {kind}")
    return ", ".join(columns)


def _footer(path: str, tail: bytes | None, length: int | None, open_file=None) -> str:
    """The schema of one file, from the bytes Spark fetched or from those fetched here."""
    fetched = tail is None
    if fetched:
        tail, length = _fetched(path, TAIL_BYTES, open_file)
    size = _footer_size(tail, length)
    if size > len(tail):
        if not fetched:
            raise FileUnreachable(f"{path}: the footer has {size} bytes, {len(tail)} were fetched")
        tail, length = _fetched(path, size, open_file)
    return _schema_of(tail)


def _footers(batches: Iterator[pd.DataFrame], list_all: bool = False) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        tails = batch["tail"] if "tail" in batch else [None] * len(batch)
        lengths = batch["length"] if "tail" in batch else [None] * len(batch)
        for path, tail, length in zip(batch["path"], tails, lengths):
            try:
                found.append((path, _footer(path, tail, length), SOUND, None))
            except DamagedFile as problem:  # reported, not fatal
                found.append((path, None, DAMAGED, str(problem)))
            except FileUnreachable as problem:  # says nothing about the file: fails the task, unless all is to be listed
                if not list_all:
                    raise
                found.append((path, None, REFUSED if isinstance(problem, FileRefused) else UNREACHABLE, str(problem)))
        yield pd.DataFrame(found, columns=["path", "schema", "verdict", "error"])


def file_schemas(files: DataFrame, tasks: int | None = None, list_unreachable: bool = False) -> DataFrame:
    """``path, schema, verdict, error`` for each file, footers read in parallel on the executors.

    First the bytes are fetched, with retries, then they are parsed. Only what fails in the second
    step makes a file ``damaged``. A file that cannot be fetched fails the job, or with
    ``list_unreachable`` is listed as ``unreachable`` or ``refused``. ``files`` of a system that
    only Spark can open bring their bytes along (``list_files`` adds ``tail`` and ``length``).

    Files are spread by ranges of ``path`` and stay in that order inside a partition.
    """
    tasks = tasks or files.sparkSession.sparkContext.defaultParallelism
    columns = [c for c in ("path", "length", "tail") if c in files.columns]
    spread = files.select(*columns).repartitionByRange(tasks, "path").sortWithinPartitions("path")
    return spread.mapInPandas(partial(_footers, list_all=list_unreachable), FOOTER_DDL)


def unreadable_files(schemas: DataFrame) -> DataFrame:
    """Files whose footer could not be read, with the reason."""
    return schemas.filter(F.col("error").isNotNull()).select("path", "error")


def _collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge neighbours of equal schema; the input is one sorted partition, a stretch of the files."""
    from pyspark import TaskContext

    columns, piece, place = ["stretch", "place", "first_file", "last_file", "files", "schema"], None, 0
    stretch = TaskContext.get().partitionId()
    for batch in batches:
        done = []
        for path, schema in zip(batch["path"], batch["schema"], strict=True):
            if schema is None:
                continue
            if piece is not None and piece[5] == schema:
                piece = (*piece[:3], path, piece[4] + 1, schema)
                continue
            if piece is not None:
                done.append(piece)
            place += 1
            piece = (stretch, place, path, path, 1, schema)
        yield pd.DataFrame(done, columns=columns)
    if piece is not None:
        yield pd.DataFrame([piece], columns=columns)


def schema_runs(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Runs of consecutive files (by path) with one schema.

    Columns ``run`` (1-based), ``first_file``, ``last_file``, ``files`` and ``schema``. Unreadable
    files do not interrupt a run. ``files`` may also be the entries of a ledger, whose schemas are known.

    No task sees all runs, even where every file has another schema than the one before. Each
    task merges its own stretch of files into pieces. A stretch is summed up by its first and last
    schema and its pieces; from these few rows follow the runs that begin before it, and whether its
    first piece goes on with the run before.
    """
    if "schema" in files.columns:
        tasks = tasks or files.sparkSession.sparkContext.defaultParallelism
        known = files.select("path", "schema").repartitionByRange(tasks, "path").sortWithinPartitions("path")
    else:
        known = file_schemas(files, tasks).select("path", "schema")
    pieces = written(known.mapInPandas(_collapse, PIECE_DDL), "pieces")
    ends = pieces.groupBy("stretch").agg(  # one row for each task
        F.max("place").alias("pieces"),
        F.min_by("schema", "place").alias("first"),
        F.max_by("schema", "place").alias("last"),
    )
    before = ends.select(F.col("stretch").alias("earlier"), F.col("last").alias("earlier_last"))
    joined = ends.join(F.broadcast(before), F.col("earlier") < F.col("stretch"), "left")
    begun = joined.groupBy("stretch", "pieces", "first").agg(F.max(F.struct("earlier", "earlier_last")).alias("previous"))
    goes_on = F.coalesce(F.col("previous.earlier_last") == F.col("first"), F.lit(False)).cast("int")
    begun = begun.withColumn("goes_on", goes_on).withColumn("begins", F.col("pieces") - F.col("goes_on"))
    totals = begun.select(F.col("stretch").alias("earlier"), F.col("begins").alias("earlier_begins"))
    offsets = begun.join(F.broadcast(totals), F.col("earlier") < F.col("stretch"), "left")
    offsets = offsets.groupBy("stretch", "goes_on").agg(F.coalesce(F.sum("earlier_begins"), F.lit(0)).alias("offset"))
    numbered = pieces.join(F.broadcast(offsets), "stretch")
    return (
        numbered.groupBy((F.col("offset") + F.col("place") - F.col("goes_on")).alias("run"), "schema")
        .agg(
            F.min("first_file").alias("first_file"),
            F.max("last_file").alias("last_file"),
            F.sum("files").alias("files"),
        )
        .select("run", "first_file", "last_file", "files", "schema")
        .orderBy("run")
    )


def month_grid(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Every (year, month) of a span of years."""
    months = spark.range(12 * (last - first + 1))
    return months.select(
        (F.lit(first) + F.floor(F.col("id") / 12)).cast("int").alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
    )


def observed_months(trips: DataFrame) -> DataFrame:
    """Trips per pickup month; uses the partition columns where the table has them."""
    if {"year", "month"} <= set(trips.columns):
        keys = [F.col("year"), F.col("month")]
    else:
        keys = [F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month")]
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("item_count"))


def file_months(files: DataFrame) -> DataFrame:
    """Files per month, read off a ``YYYY-MM`` in the file name."""
    pattern = r"(\d{4})-(\d{2})[^/]*$"
    dated = files.filter(F.col("path").rlike(pattern))
    return dated.groupBy(
        F.regexp_extract("path", pattern, 1).cast("int").alias("year"),
        F.regexp_extract("path", pattern, 2).cast("int").alias("month"),
    ).agg(F.count(F.lit(1)).alias("item_count"))


def month_coverage(observed: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """The month grid with ``item_count`` (0 where nothing was seen) and ``present``."""
    grid = month_grid(observed.sparkSession, first, last)
    return (
        grid.join(observed, ["year", "month"], "left")
        .withColumn("present", F.col("item_count").isNotNull())
        .withColumn("item_count", F.coalesce(F.col("item_count"), F.lit(0).cast("long")))
        .orderBy("year", "month")
    )


def missing_months(observed: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Months of the grid in which nothing was seen."""
    return month_grid(observed.sparkSession, first, last).join(observed, ["year", "month"], "left_anti")
