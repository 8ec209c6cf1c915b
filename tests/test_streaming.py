from __future__ import annotations

import datetime as dt

import __spark_entry__ as entry
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tripweave import fixtures
from tripweave.plans.etl import clean_trips
from tripweave.schemas import CLEAN_SCHEMA, MODERN
from tripweave.sources.trips import read_clean
from tripweave.streaming import live


def test_cleaning_a_stream_equals_cleaning_the_table(spark, make_trips, zones, tmp_path):
    july = {"pickup": "2019-07-01 09:00:00", "dropoff": "2019-07-01 09:30:00"}
    trips = make_trips({}, {"trip_distance": 0.0}, {"PULocationID": 264}, july)
    arriving, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        stream = clean_trips(live.stream_standard(spark, arriving, files_per_batch=1), zones)
        live.append_clean(stream, out, progress, once=True).awaitTermination()

    trips.repartition(3).write.parquet(arriving)
    run()
    expected = clean_trips(trips, zones)
    got = read_clean(spark, out).select(*CLEAN_SCHEMA.names)
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count() == 2
    trips.write.mode("append").parquet(arriving)
    run()
    run()  # nothing new arrives
    assert read_clean(spark, out).count() == 4


def test_streamed_era_files(spark, tmp_path):
    frame = spark.sql(
        """SELECT timestamp_ntz'2023-05-01 10:00:00' tpep_pickup_datetime, timestamp_ntz'2023-05-01 10:30:00'
           tpep_dropoff_datetime, 1.5D trip_distance, 9.0D total_amount, 2L passenger_count, 4L PULocationID,
           7L DOLocationID, 1.25D Airport_fee"""
    )
    frame.write.parquet(str(tmp_path / "in"))
    stream = live.stream_era(spark, MODERN, str(tmp_path / "in"))
    query = stream.writeStream.format("memory").queryName("era_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    (row,) = stream.sparkSession.table("era_rows").collect()
    assert (row["airport_fee"], row["passenger_count"]) == (1.25, 2)


def counted(spark, trips, zones, tmp_path, *extra):
    """Every frame of trips is a file of its own, taken in the order given."""
    arriving, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for more in (trips, *extra):
        more.coalesce(1).write.mode("append").parquet(arriving)
        stream = clean_trips(live.stream_standard(spark, arriving, files_per_batch=1), zones)
        live.write_hourly_counts(live.hourly_borough_counts(stream), out, progress, once=True).awaitTermination()
    rows = live.read_hourly_counts(spark, out).collect()
    return sorted((r["hour_start"], r["pickup_borough"], r["trip_count"]) for r in rows)


def test_hourly_counts_of_late_and_stray_trips(spark, make_trips, zones, tmp_path):
    def at(*times):
        return make_trips(*[{"pickup": f"{t}:10:00", "dropoff": f"{t}:40:00"} for t in times])

    stray = at("2011-01-01 08", "2024-12-31 23")
    got = counted(spark, stray, zones, tmp_path, at("2011-03-01 08", "2011-03-01 08"), at("2011-02-01 08"), at("2011-03-01 08"))
    assert [(str(hour), n) for hour, _, n in got] == [
        ("2011-01-01 08:00:00", 1), ("2011-02-01 08:00:00", 1), ("2011-03-01 08:00:00", 3), ("2024-12-31 23:00:00", 1),
    ]


def test_hours_do_not_depend_on_the_session_zone(spark, make_trips):
    trips = make_trips(*[{"pickup": f"2024-03-10 0{h}:30:15.5"} for h in (1, 2, 3)]).withColumn("pickup_borough", F.lit("x"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hours = sorted(r["hour_start"] for r in live.hourly_borough_counts(trips).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hours == [dt.datetime(2024, 3, 10, h) for h in (1, 2, 3)]


def minutes(make_trips, day, n):
    return make_trips(*[{"pickup": f"2019-06-{day:02d} {h:02d}:00:00", "dropoff": f"2019-06-{day:02d} {h:02d}:30:00"} for h in range(n)])


def test_counts_of_many_batches_stay_in_few_files(spark, make_trips, zones, tmp_path):
    """Batches of one file each, with a restart in between; compaction every four batches."""
    arriving, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    trips = minutes(make_trips, 1, 20).unionByName(minutes(make_trips, 2, 10))
    most = 0
    for _ in range(2):
        trips.repartition(15).write.mode("append").parquet(arriving)
        stream = clean_trips(live.stream_standard(spark, arriving, files_per_batch=1), zones)
        counts = live.hourly_borough_counts(stream)
        live.write_hourly_counts(counts, out, progress, once=True, compact_every=4).awaitTermination()
        most = max(most, len(list((tmp_path / "out" / "changes").glob("batch=*"))))
        assert len(list((tmp_path / "out" / "snapshots").glob("v=*"))) <= 2
    got = {(r["hour_start"].day, r["hour_start"].hour): r["trip_count"] for r in live.read_hourly_counts(spark, out).collect()}
    assert got == {(d, h): 2 for d, n in ((1, 20), (2, 10)) for h in range(n)} and most <= 4
    live.compact_counts(spark, out)
    live.compact_counts(spark, out)
    again = {(r["hour_start"].day, r["hour_start"].hour): r["trip_count"] for r in live.read_hourly_counts(spark, out).collect()}
    assert again == got and not list((tmp_path / "out" / "changes").glob("batch=*"))


def test_a_compaction_that_died_loses_and_doubles_nothing(spark, tmp_path):
    def batch(n, *rows):
        spark.createDataFrame(rows, live.COUNTS_DDL).write.mode("overwrite").parquet(f"{tmp_path}/changes/batch={n}")

    def counts():
        return {(r["pickup_borough"], r["trip_count"]) for r in live.read_hourly_counts(spark, str(tmp_path)).collect()}

    hour = dt.datetime(2020, 1, 1)
    batch(0, (hour, "a", 1))
    batch(1, (hour, "a", 3), (hour, "b", 1))
    live.compact_counts(spark, str(tmp_path))
    batch(1, (hour, "a", 3), (hour, "b", 1))  # died before it removed a merged batch
    batch(2, (hour, "b", 2))
    assert counts() == {("a", 3), ("b", 2)}
    live.compact_counts(spark, str(tmp_path))
    (tmp_path / "snapshots" / "v=1" / "_SUCCESS").unlink()  # died before the snapshot was whole
    batch(2, (hour, "b", 2))
    assert counts() == {("a", 3), ("b", 2)}


def test_each_batch_sees_the_zones_of_its_time(spark, make_trips, zones, tmp_path):
    arriving, out, progress, stored = (str(tmp_path / n) for n in ("in", "out", "progress", "zones"))
    zones.write.parquet(stored)

    def run():
        stream = live.stream_standard(spark, arriving, files_per_batch=1)
        query = live.clean_batches(stream, lambda s: s.read.parquet(stored), out, progress, once=True)
        query.awaitTermination()

    make_trips({}, {"PULocationID": 300}).coalesce(1).write.mode("append").parquet(arriving)
    run()
    assert live.read_batches(spark, out).count() == 1
    spark.createDataFrame([(300, "Bronx", "x", "y")], zones.schema).write.mode("append").parquet(stored)
    make_trips({}, {"PULocationID": 300}).coalesce(1).write.mode("append").parquet(arriving)
    run()
    rows = live.read_batches(spark, out)
    assert sorted(r["pickup_borough"] for r in rows.collect()) == ["Bronx", "Manhattan", "Manhattan"]
    assert rows.columns == [*CLEAN_SCHEMA.names, "year", "month"]
    spark.createDataFrame([(300, "Queens", "x", "y")], zones.schema).write.mode("append").parquet(stored)
    make_trips({}).coalesce(1).write.mode("append").parquet(arriving)
    with pytest.raises(Exception, match="not unique"):
        run()
    assert live.read_batches(spark, out).count() == 3
    spark.createDataFrame([(300, "Bronx", "x", "y"), (4, "Manhattan", "m", "n"), (7, "Queens", "q", "r")], zones.schema).write.mode(
        "overwrite"
    ).parquet(stored)
    run()  # the batch that failed is taken again
    assert live.read_batches(spark, out).count() == 4


def test_arriving_files_grow_in_number_and_not_in_size(spark, monkeypatch, tmp_path):
    trips = fixtures.order_trips(spark, TINY)
    assert entry._arrive(spark, TINY, str(tmp_path / "few"), F.to_date("pickup_datetime")) == 1
    monkeypatch.setattr(fixtures, "PIECE_BYTES", 10_000)
    assert entry._arrive(spark, TINY, str(tmp_path / "many"), F.to_date("pickup_datetime")) == 4
    for name, n in (("few", 3), ("many", 12)):
        stored = spark.read.parquet(str(tmp_path / name))
        sizes = [r["count"] for r in stored.groupBy(F.col("_metadata.file_path")).count().collect()]
        assert len(sizes) == n and max(sizes) < 2 * sum(sizes) / n
        assert sum(sizes) == trips.count() and stored.exceptAll(trips).isEmpty()
