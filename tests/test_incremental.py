"""Loads of what changed against loading everything."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tripweave import fixtures
from tripweave.plans import incremental
from tripweave.plans.etl import clean_trips
from tripweave.schemas import CLEAN_SCHEMA
from tripweave.sources import ledger, snapshots

from conftest import TINY


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips") / "all")
    fixtures.order_trips(spark, TINY).write.parquet(path)
    return spark.read.parquet(path)


def as_loaded(trips, zones):
    """Fees of the oldest files are not stored."""
    fee = F.when(F.year("pickup_datetime") <= 2013, 0.0).otherwise(F.col("airport_fee"))
    rows = trips.where("year(pickup_datetime) >= 2011").withColumn("airport_fee", fee)
    return sorted(map(tuple, clean_trips(rows, zones).collect()))


def test_loads_equal_a_whole_load(spark, trips, tmp_path):
    raw, table, kept = (str(tmp_path / n) for n in ("raw", "table", "ledger"))
    zones = fixtures.nation_zones(spark, TINY)
    month = F.date_format("pickup_datetime", "yyyy-MM")

    def load():
        return incremental.load_changes(spark, raw, zones, table, kept, eras=fixtures.MONTH_ERAS)

    def rows(**which):
        return sorted(map(tuple, incremental.read_table(spark, table, **which).select(*CLEAN_SCHEMA.names).collect()))

    early = trips.where(month.between("2011-01", "2012-06") | month.between("2014-01", "2014-03"))
    stale = early.withColumn("total_amount", F.when(month == "2012-02", F.col("total_amount") + 1).otherwise(F.col("total_amount")))
    fixtures.write_month_files(stale, raw)
    first = load()
    assert len(first) == 21 and rows() == as_loaded(stale, zones)
    assert load() == [] and len(snapshots.versions(spark, f"{table}/state")) == 1
    fixtures.write_month_files(trips.where(month.isin("2012-02", "2012-07")), raw)
    os.remove(fixtures.month_file(raw, "2011-05"))
    assert load() == ["2011-05", "2012-02", "2012-07"]
    now = trips.where(month.between("2011-01", "2012-07") | month.between("2014-01", "2014-03")).where(month != "2011-05")
    assert rows() == as_loaded(now, zones)
    assert rows(years=(2012, 2012), months=[2, 7]) == as_loaded(now.where(month.isin("2012-02", "2012-07")), zones)
    loads = {r["load"] for r in incremental.state(spark, table).where("kind = 'month'").collect()}
    assert loads == {0, 1}


def test_a_file_that_feeds_other_months(spark, make_trips, zones, tmp_path):
    """A stray trip moves from one month to another; the month it left keeps what other files feed it."""
    raw, table, kept = (str(tmp_path / n) for n in ("raw", "table", "ledger"))
    os.mkdir(raw)

    def put(month, *pickups):
        rows = make_trips(*[{"pickup": f"{p} 10:00:00", "dropoff": f"{p} 10:30:00"} for p in pickups])
        rows = rows.withColumnsRenamed({f"{e}_datetime": f"tpep_{e}_datetime" for e in ("pickup", "dropoff")})
        rows.toPandas().to_parquet(f"{raw}/yellow_tripdata_{month}.parquet", coerce_timestamps="us")

    def load():
        got = incremental.load_changes(spark, raw, zones, table, kept)
        counts = incremental.read_table(spark, table).groupBy("year", "month").count().collect()
        return got, {(r["year"], r["month"]): r["count"] for r in counts}

    put("2019-06", "2019-06-01", "2019-07-01", "2019-07-02")
    put("2019-07", "2019-07-05")
    assert load() == (["2019-06", "2019-07"], {(2019, 6): 1, (2019, 7): 3})
    put("2019-06", "2019-06-01", "2019-06-02")
    assert load() == (["2019-06", "2019-07"], {(2019, 6): 2, (2019, 7): 1})
    with open(f"{raw}/yellow_tripdata_2019-07.parquet", "wb") as damaged:
        damaged.write(b"cut")
    assert load() == (["2019-07"], {(2019, 6): 2})  # a damaged file feeds nothing any more
    assert ledger.remainder(ledger.entries(spark, kept)).count() == 1
    # a load that died before its state was written is not seen, and the next one takes its place
    os.mkdir(f"{table}/data/load=9")
    put("2019-08", "2019-08-01")
    assert load()[1] == {(2019, 6): 2, (2019, 8): 1}


def test_a_table_without_loads_is_empty(spark, tmp_path):
    assert incremental.read_table(spark, str(tmp_path / "table")).count() == 0
