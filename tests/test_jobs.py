"""Raw monthly files to report, with the whole path on disk."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripweave.plans import jobs
from tripweave.sources.trips import read_clean

ZONES = """LocationID,Borough,Zone,service_zone
1,EWR,Newark Airport,EWR
138,Queens,LaGuardia Airport,Airports
256,Brooklyn,Williamsburg (South Side),Boro Zone
170,Manhattan,Murray Hill,Yellow Zone
264,Unknown,N/A,N/A
"""
# pickup, dropoff, from, to, miles, amount, passengers
TRIPS = {
    "2011-01": [
        ("2011-01-01 00:58:10", "2011-01-01 01:15:35", 138, 256, 8.0, 21.1, 1),
        ("2011-01-01 00:10:00", "2011-01-01 00:12:00", 170, 170, 0.0, 4.18, 4),
    ],
    "2018-07": [
        ("2018-07-04 12:00:00", "2018-07-04 12:30:00", 170, 1, 17.5, 90.0, None),
        ("2018-07-04 12:00:00", "2018-07-04 12:30:00", 170, 264, 17.5, 90.0, 1),
    ],
    "2024-12": [("2024-12-31 23:40:00", "2025-01-01 00:10:00", 170, 138, 9.0, 50.0, 2)],
}


@pytest.fixture
def paths(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for month, rows in TRIPS.items():
        at = [pa.array([dt.datetime.fromisoformat(r[i]) for r in rows], pa.timestamp("us")) for i in (0, 1)]
        columns = {
            "tpep_pickup_datetime": at[0],
            "tpep_dropoff_datetime": at[1],
            "PULocationID": pa.array([r[2] for r in rows], pa.int64()),
            "DOLocationID": pa.array([r[3] for r in rows], pa.int64()),
            "trip_distance": pa.array([r[4] for r in rows]),
            "total_amount": pa.array([r[5] for r in rows]),
            "passenger_count": pa.array([r[6] for r in rows], pa.float64() if month == "2018-07" else pa.int64()),
        }
        if month != "2011-01":
            columns["airport_fee" if month == "2018-07" else "Airport_fee"] = pa.array([None] * len(rows), pa.float64())
        pq.write_table(pa.table(columns), raw / f"yellow_tripdata_{month}.parquet")
    (tmp_path / "zones.csv").write_text(ZONES)
    return {"raw": str(raw), "zones": str(tmp_path / "zones.csv"), "out": str(tmp_path / "out"), "root": tmp_path}


def test_strict_job(spark, paths):
    jobs.strict_etl(spark, paths["raw"], paths["zones"], paths["out"], shuffle=False)
    got = read_clean(spark, paths["out"]).orderBy("pickup_datetime").collect()
    columns = ("trip_duration_mins", "pickup_borough", "dropoff_borough", "year", "month")
    assert [tuple(r[c] for c in columns) for r in got] == [
        (17.42, "Queens", "Brooklyn", 2011, 1),
        (30.0, "Manhattan", "EWR", 2018, 7),
    ]
    assert [r["passenger_count"] for r in got] == [1, 1]
    stats, slowest = jobs.analytics(spark, paths["out"], str(paths["root"] / "report"))
    assert stats.first()["samples"] == 12 and slowest.count() == 3
    routes = spark.read.parquet(str(paths["root"] / "report" / "insight=top_routes"))
    assert routes.count() == 2


def test_basic_job(spark, paths):
    with open(f"{paths['raw']}/yellow_tripdata_2019-05.parquet", "wb") as bad:
        bad.write(b"cut short")
    rejects = jobs.basic_etl(spark, paths["raw"], paths["zones"], paths["out"], files=2)
    got = spark.read.parquet(paths["out"]).orderBy("tpep_pickup_datetime").collect()
    # The trip without a passenger count goes, the one that ends in 2025 stays.
    assert [r["trip_duration_mins"] for r in got] == [17.42, 30.0]
    assert [r["dropoff_borough"] for r in got] == ["Brooklyn", "Queens"]
    assert rejects.count() == 1


def test_inspection(spark, paths):
    runs, missing, damaged = jobs.inspect_files(spark, paths["raw"])
    assert runs.count() == 3 and missing.count() == 165
