"""Physical layouts of the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYOUT_KEYS = ("year", "month")


def with_layout_columns(trips: DataFrame) -> DataFrame:
    """Add the partition columns ``year`` and ``month`` of the pickup."""
    pickup = F.col("pickup_datetime")
    return trips.withColumns({"year": F.year(pickup), "month": F.month(pickup)})


def write_clean(
    trips: DataFrame,
    path: str,
    tasks: int | None = None,
    splits: int = 1,
    shuffle: bool = True,
    compression: str = "snappy",
    replace_months_only: bool = False,
    max_records_per_file: int | None = None,
) -> None:
    """Overwrite a Parquet table partitioned by year and month.

    By default Spark rebalances by month: after the shuffle a month above the advisory
    size is split over several tasks and small months share one, so a month that holds a
    third of the data does not end up in one task. With ``tasks`` the months are hashed
    to that many tasks instead, each month cut into ``splits`` pieces by a hash of the
    row (copies of one row stay together). ``shuffle=False``
    lets every task write the months it holds: right for input files that each cover one
    month, where it saves moving the whole table.
    ``replace_months_only`` leaves months without new rows untouched.
    """
    table = with_layout_columns(trips)
    if not shuffle:
        pass
    elif tasks is None:
        table = table.hint("rebalance", *LAYOUT_KEYS)
    elif splits > 1:
        piece = F.pmod(F.xxhash64(*trips.columns), F.lit(splits))
        table = table.repartition(tasks, *LAYOUT_KEYS, piece)
    else:
        table = table.repartition(tasks, *LAYOUT_KEYS)
    writer = (
        table.write.mode("overwrite")
        .partitionBy(*LAYOUT_KEYS)
        .option("compression", compression)
        .option("partitionOverwriteMode", "dynamic" if replace_months_only else "static")
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_compact(trips: DataFrame, path: str, files: int | None = None, shuffle: bool = True) -> None:
    """Overwrite an unpartitioned Parquet folder.

    By default files have about the advisory partition size, however large the table is;
    with ``files`` there are at most so many.

    ``shuffle=False`` merges partitions without moving rows, but then the work feeding the
    write runs in ``files`` tasks too.
    """
    if files is None:
        packed = trips.hint("rebalance")
    else:
        packed = trips.repartition(files) if shuffle else trips.coalesce(files)
    packed.write.mode("overwrite").parquet(path)


def write_bucketed(trips: DataFrame, table: str, buckets: int, key: str = "pickup_borough") -> None:
    """Overwrite a catalog table bucketed by ``key``, so grouping by it needs no shuffle."""
    trips.write.mode("overwrite").format("parquet").bucketBy(buckets, key).saveAsTable(table)
