from __future__ import annotations

import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripweave.operators import audit
from tripweave.plans.etl import clean_trips
from tripweave.sources.trips import list_files

LONG, DOUBLE = pa.int64(), pa.float64()


@pytest.fixture
def folder(tmp_path):
    def write(month, dtype, name="passenger_count"):
        table = pa.table({name: pa.array([1], dtype), "t": pa.array([0], pa.timestamp("us"))})
        pq.write_table(table, tmp_path / f"yellow_tripdata_{month}.parquet")

    write("2018-05", LONG)
    write("2018-06", LONG)
    write("2018-07", DOUBLE)
    (tmp_path / "yellow_tripdata_2018-08.parquet").write_bytes(b"PAR1 broken")
    write("2018-09", DOUBLE)
    write("2018-10", LONG)
    return tmp_path


@pytest.mark.parametrize("tasks", [1, 2, 3, 8])
def test_runs_do_not_depend_on_how_files_are_spread(spark, folder, tasks):
    runs = audit.schema_runs(list_files(spark, str(folder)), tasks).collect()
    got = [(r["run"], r["first_file"][-15:-8], r["last_file"][-15:-8], r["files"]) for r in runs]
    assert got == [(1, "2018-05", "2018-06", 2), (2, "2018-07", "2018-09", 2), (3, "2018-10", "2018-10", 1)]
    assert [r["schema"] for r in runs] == [
        "`passenger_count` bigint, `t` timestamp_ntz",
        "`passenger_count` double, `t` timestamp_ntz",
        "`passenger_count` bigint, `t` timestamp_ntz",
    ]


def test_spelling_and_time_unit(spark, folder):
    nano = pa.table({"Passenger_Count": pa.array([1], LONG), "t": pa.array([0], pa.timestamp("ms"))})
    pq.write_table(nano, folder / "yellow_tripdata_2018-11.parquet")
    runs = audit.schema_runs(list_files(spark, str(folder))).collect()
    assert runs[-1]["schema"] == "`Passenger_Count` bigint, `t` timestamp_ntz" and len(runs) == 4


def test_schemas_match_what_spark_reads(spark, clean_path):
    files = list_files(spark, clean_path, "*.parquet")
    (schema,) = {r["schema"] for r in audit.file_schemas(files).collect()}
    read = spark.read.parquet(f"{clean_path}/year=2012/month=3").schema
    assert schema == ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read)


def test_task_functions_need_no_package_on_executors(folder):
    from pyspark import cloudpickle

    script = (
        "import pickle, sys; from pyspark import cloudpickle; f = pickle.load(sys.stdin.buffer); "
        "import pandas as pd; print(next(f([pd.DataFrame({'path': [sys.argv[1]]})]))['schema'][0])"
    )
    path = str(folder / "yellow_tripdata_2018-07.parquet")
    done = subprocess.run(
        [sys.executable, "-c", script, path],
        input=cloudpickle.dumps(audit._footers),
        capture_output=True,
        cwd="/",
        env={"PATH": "/usr/bin:/bin"},
    )
    assert done.stdout.decode().strip() == "`passenger_count` double, `t` timestamp_ntz", done.stderr.decode()
    cloudpickle.dumps(audit._collapse)


def test_month_grid(spark):
    got = [tuple(r) for r in audit.month_grid(spark).orderBy("year", "month").collect()]
    assert got == [(y, m) for y in range(2011, 2025) for m in range(1, 13)]


def test_coverage_of_trips(spark, make_trips, zones):
    trips = clean_trips(make_trips({}, {}, {"pickup": "2024-12-31 10:00:00", "dropoff": "2024-12-31 10:20:00"}), zones)
    seen = audit.observed_months(trips)
    grid = {(r["year"], r["month"]): (r["item_count"], r["present"]) for r in audit.month_coverage(seen).collect()}
    assert len(grid) == 168 and grid[2019, 6] == (2, True) and grid[2024, 12] == (1, True)
    assert grid[2011, 1] == (0, False)
    assert audit.missing_months(seen).count() == 166


def test_coverage_of_files(spark, folder):
    months = audit.file_months(list_files(spark, str(folder)))
    missing = {tuple(r) for r in audit.missing_months(months, 2018, 2018).collect()}
    assert missing == {(2018, m) for m in (1, 2, 3, 4, 11, 12)}
