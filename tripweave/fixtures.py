"""Trips and zones derived from order tables, for tests and benchmarks.

One trip per line item; all numbers are integer formulas of the keys, so another SQL
engine can derive exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.schemas import DOUBLE, INT, LEGACY, LONG, MIDDLE, MODERN, TEXT, TIME, TRIP_SCHEMA, Era, table
from tripweave.sources import snapshots

AIRPORT_BOROUGH = ("AFRICA",)
PIECE_BYTES = 32 << 20  # of stored line items, for the trips of one file


# The columns used, with their stored types; naming them spares a footer job per table.
TABLES = {
    "region": table(("r_regionkey", INT), ("r_name", TEXT)),
    "nation": table(("n_nationkey", INT), ("n_name", TEXT), ("n_regionkey", INT)),
    "customer": table(("c_custkey", LONG), ("c_nationkey", INT)),
    "supplier": table(("s_suppkey", LONG), ("s_nationkey", INT)),
    "orders": table(("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderdate", TIME)),
    "lineitem": table(
        ("l_orderkey", LONG),
        ("l_partkey", LONG),
        ("l_suppkey", LONG),
        ("l_linenumber", INT),
        ("l_quantity", DOUBLE),
        ("l_extendedprice", DOUBLE),
        ("l_tax", DOUBLE),
    ),
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def order_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips with gaps and errors, in ``TRIP_SCHEMA``."""
    years = F.when(F.col("o_orderkey") % 97 == 0, 40).otherwise(16)
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.timestamp_add("YEAR", years, F.col("o_orderdate")).alias("base")
    )
    # customers meet the orders first, so that the line items move once
    orders = orders.join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        _table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    start = (F.col("o_orderkey") * 7919 + F.col("l_linenumber") * 131) % 1440
    length = (F.col("l_partkey") * 37 + F.col("l_suppkey")) % 260 - 5
    # Seconds on top in two of three rows, so that durations have to be rounded.
    seconds = F.when(F.col("l_partkey") % 3 != 0, (F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % 60).otherwise(0)
    passengers = ((F.col("l_linenumber") + F.col("l_partkey")) % 8).cast("int")
    located = {
        "PULocationID": F.when(F.col("c_nationkey") != 24, F.col("c_nationkey").cast("long")),
        "DOLocationID": F.when(F.col("s_nationkey") != 24, F.col("s_nationkey").cast("long")),
    }
    return lines.select(
        F.timestamp_add("MINUTE", start, F.col("base")).alias("pickup_datetime"),
        F.timestamp_add("SECOND", (start + length) * 60 + seconds, F.col("base")).alias("dropoff_datetime"),
        *[value.alias(name) for name, value in located.items()],
        ((F.col("l_quantity") - 2) * 0.5).alias("trip_distance"),
        (F.floor(F.col("l_extendedprice") * 4 / 50) / F.lit(4.0)).alias("total_amount"),
        F.when(passengers != 7, passengers).alias("passenger_count"),
        F.when(F.col("l_tax") > 0.06, 1.25).when(F.col("l_tax") >= 0.02, 0.0).alias("airport_fee"),
    ).select(*TRIP_SCHEMA.names)


def trip_pieces(spark: SparkSession, folder: str, least: int) -> int:
    """In how many pieces the trips of a folder are written, so that the trips of one do not grow with the folder."""
    return max(least, -(-snapshots.size(spark, f"{folder}/lineitem.parquet") // PIECE_BYTES))


def nation_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as zones and regions as boroughs, one of them unknown."""
    nations = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.when(F.col("r_name") == "MIDDLE EAST", "Unknown").otherwise(F.col("r_name")).alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("none").alias("service_zone"),
    )


def era_folders(root: str) -> dict[str, tuple[Era, str]]:
    """Folders of ``write_era_folders``, in order of their dates."""
    return {
        "legacy": (LEGACY, f"{root}/1-legacy"),
        "middle_lower": (MIDDLE, f"{root}/2-middle-lower"),
        "middle_upper": (MIDDLE, f"{root}/3-middle-upper"),
        "modern": (MODERN, f"{root}/4-modern"),
    }


# The eras as the files below have them; months before and after are of no era.
MONTH_ERAS = (
    Era("legacy", (2011, 1), (2013, 12), LEGACY.schema),
    Era("middle", (2014, 1), (2016, 12), MIDDLE.schema),
    Era("modern", (2017, 1), (2036, 12), MODERN.schema),
)


def era_frames(trips: DataFrame) -> dict[str, DataFrame]:
    """Trips the way the three eras stored them, by the folders' names.

    To 2013: text timestamps in half of the rows, no fee. 2014-2016: passengers as double
    and the fee under either spelling, by odd and even month. Later: passengers as long.
    """
    year, month = F.year("pickup_datetime"), F.month("pickup_datetime")
    as_text = F.minute("pickup_datetime") % 2 == 0
    times = {f"tpep_{end}_datetime": F.col(f"{end}_datetime") for end in ("pickup", "dropoff")}
    numbers = ["trip_distance", "total_amount", "PULocationID", "DOLocationID"]
    rest = [c for c in trips.columns if c not in TRIP_SCHEMA.names]
    legacy = trips.filter(year <= 2013).select(
        *[F.when(~as_text, ts).alias(name) for name, ts in times.items()],
        *numbers,
        F.col("passenger_count").cast("long").alias("passenger_count"),
        *[F.when(as_text, ts.cast("string")).alias(name[len("tpep_"):]) for name, ts in times.items()],
        *rest,
    )
    middle = trips.filter(year.between(2014, 2016))
    later = trips.filter(year >= 2017)
    return {"legacy": legacy} | {
        name: part.select(
            *[ts.alias(column) for column, ts in times.items()],
            *numbers,
            F.col("passenger_count").cast(passengers).alias("passenger_count"),
            F.col("airport_fee").alias(fee),
            *rest,
        )
        for name, part, passengers, fee in (
            ("middle_lower", middle.filter(month % 2 == 1), "double", "airport_fee"),
            ("middle_upper", middle.filter(month % 2 == 0), "double", "Airport_fee"),
            ("modern", later, "long", "Airport_fee"),
        )
    }


def write_era_folders(trips: DataFrame, root: str) -> None:
    """Write trips the way the three eras stored them, a folder for each way."""
    for name, part in era_frames(trips).items():
        part.write.mode("overwrite").parquet(era_folders(root)[name][1])


def write_month_files(trips: DataFrame, root: str) -> None:
    """Write trips the way the eras stored them, one file for each month, named by it; a file that is there is replaced."""
    spark = trips.sparkSession
    dated = trips.withColumn("file_month", F.date_format("pickup_datetime", "yyyy-MM"))
    for name, part in era_frames(dated).items():
        staged = f"{root}-staged-{name}"
        part.repartition("file_month").write.partitionBy("file_month").mode("overwrite").parquet(staged)
        _place(spark, staged, root)


def damage_months(spark: SparkSession, root: str, months: DataFrame) -> None:
    """Put something else in the place of the files of ``months`` (``file_month``)."""
    staged = f"{root}-staged-damage"
    junk = months.select(F.lit("not a Parquet file any more").alias("value"), "file_month")
    junk.repartition("file_month").write.partitionBy("file_month").mode("overwrite").text(staged)
    _place(spark, staged, root)


def month_file(root: str, month: str) -> str:
    return f"{root}/yellow_tripdata_{month}.parquet"


def _place(spark: SparkSession, staged: str, root: str) -> None:
    """The one file of every month folder, under its name in ``root``."""
    snapshots.make(spark, root)
    for folder in snapshots.children(spark, staged):
        if folder.startswith("file_month="):
            (name,) = [n for n in snapshots.children(spark, f"{staged}/{folder}") if n.startswith("part-")]
            target = month_file(root, folder.removeprefix("file_month="))
            snapshots.remove(spark, target)
            snapshots.rename(spark, f"{staged}/{folder}/{name}", target)
    snapshots.remove(spark, staged)
