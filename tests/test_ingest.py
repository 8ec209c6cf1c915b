from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripweave import fixtures
from tripweave.operators import audit
from tripweave.operators.standardize import standardize, union_standard
from tripweave.schemas import ERAS, LEGACY, MIDDLE, MODERN, TRIP_SCHEMA
from tripweave.session import case_sensitive
from tripweave.sources import trips as sources
from tripweave.sources.zones import read_zones

from conftest import TINY

NOON = dt.datetime(2015, 5, 1, 12, 0, 0)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def month_file(folder, month, passengers=pa.int64(), fee=None, text=False):
    """One raw file with a single trip picked up at noon."""
    columns = {
        "tpep_pickup_datetime": pa.array([None if text else NOON], pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([None if text else NOON], pa.timestamp("us")),
        "trip_distance": pa.array([1.5]),
        "total_amount": pa.array([9.0]),
        "passenger_count": pa.array([2], passengers),
        "PULocationID": pa.array([4], pa.int64()),
        "DOLocationID": pa.array([7], pa.int64()),
    }
    if text:
        columns["pickup_datetime"] = pa.array(["2015-05-01 12:00:00"])
        columns["dropoff_datetime"] = pa.array(["2015-05-01 12:00:00"])
    if fee:
        columns[fee] = pa.array([1.25])
    pq.write_table(pa.table(columns), f"{folder}/yellow_tripdata_{month}.parquet")


@pytest.fixture
def raw_folder(tmp_path):
    month_file(tmp_path, "2011-01")
    month_file(tmp_path, "2018-06", text=True)
    month_file(tmp_path, "2018-07", passengers=pa.float64(), fee="airport_fee")
    month_file(tmp_path, "2023-01", passengers=pa.float64(), fee="airport_fee")
    month_file(tmp_path, "2023-02", fee="Airport_fee")
    return tmp_path


def test_schema_of_every_reader(spark, raw_folder):
    assert sources.read_eras(spark, str(raw_folder)).schema == TRIP_SCHEMA
    file = str(raw_folder / "yellow_tripdata_2018-07.parquet")
    assert [f.dataType for f in sources.read_file(spark, file).schema] == [f.dataType for f in TRIP_SCHEMA]


def test_eras_cover_each_month_once():
    import fnmatch

    months = [f"yellow_tripdata_{y}-{m:02d}.parquet" for y in range(2011, 2025) for m in range(1, 13)]

    def matches(era, name):
        stem, rest = era.name_pattern().split("{")
        options, tail = rest.split("}")
        return any(fnmatch.fnmatch(name, stem + option + tail) for option in options.split(","))

    found = {name: [era.name for era in ERAS if matches(era, name)] for name in months}
    assert all(len(names) == 1 for names in found.values())
    assert found["yellow_tripdata_2018-06.parquet"] == ["legacy"]
    assert found["yellow_tripdata_2018-07.parquet"] == ["middle"]
    assert found["yellow_tripdata_2023-01.parquet"] == ["middle"]
    assert found["yellow_tripdata_2023-02.parquet"] == ["modern"]
    assert len([n for n in found.values() if n == ["legacy"]]) == 90


def test_eras_by_file_name(spark, raw_folder):
    got = rows(sources.read_eras(spark, str(raw_folder)))
    fees = sorted(r[7] for r in got)
    assert fees == [0.0, 0.0, 1.25, 1.25, 1.25]
    assert {r[:7] for r in got} == {(NOON, NOON, 4, 7, 1.5, 9.0, 2)}


def test_an_era_without_files_is_empty(spark, tmp_path):
    month_file(tmp_path, "2024-03")
    assert sources.read_eras(spark, str(tmp_path)).count() == 1


def test_file_by_file_matches_era_scans(spark, raw_folder):
    files = sorted(str(p) for p in raw_folder.iterdir())
    single = union_standard([sources.read_file(spark, f) for f in files])
    drifting, rejects = sources.read_drifting(spark, sources.list_files(spark, str(raw_folder)))
    assert rows(single) == rows(drifting) == rows(sources.read_eras(spark, str(raw_folder)))
    assert rejects.count() == 0


def test_unreadable_files_are_skipped_and_reported(spark, raw_folder):
    (raw_folder / "yellow_tripdata_2019-01.parquet").write_bytes(b"not parquet")
    files = sources.list_files(spark, str(raw_folder))
    trips, rejects = sources.read_drifting(spark, files)
    assert trips.count() == 5
    (bad,) = rejects.collect()
    assert bad["path"].endswith("2019-01.parquet") and bad["error"]
    (bad,) = audit.unreadable_files(audit.file_schemas(files)).collect()
    assert bad["path"].endswith("2019-01.parquet")


def test_untyped_and_dictionary_columns(spark, tmp_path):
    month_file(tmp_path, "2018-07", passengers=pa.float64())
    file = tmp_path / "yellow_tripdata_2018-07.parquet"
    table = pq.read_table(file)
    table = table.append_column("airport_fee", pa.nulls(1)).append_column("odd`name", pa.array(["N"]).dictionary_encode())
    pq.write_table(table, file)
    files = sources.list_files(spark, str(tmp_path))
    (schema,) = [r["schema"] for r in audit.file_schemas(files).collect()]
    inferred = case_sensitive(spark).read.parquet(str(file)).schema
    assert schema.endswith("`airport_fee` int, `odd``name` string")
    assert [f.dataType.simpleString() for f in inferred][-2:] == ["int", "string"]
    drifting, rejects = sources.read_drifting(spark, files)
    assert rows(drifting) == rows(sources.read_eras(spark, str(tmp_path))) == rows(sources.read_file(spark, str(file)))
    assert drifting.first()["airport_fee"] is None and rejects.count() == 0


def test_era_scans_can_go_on_without_a_damaged_file(spark, raw_folder):
    (raw_folder / "yellow_tripdata_2019-01.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="2019-01"):
        sources.read_eras(spark, str(raw_folder)).collect()
    assert sources.read_eras(spark, str(raw_folder), skip_unreadable=True).count() == 5


def test_nothing_readable_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.list_files(spark, str(tmp_path))
    (tmp_path / "yellow_tripdata_2019-01.parquet").write_bytes(b"not parquet")
    with pytest.raises(FileNotFoundError):
        sources.read_drifting(spark, sources.list_files(spark, str(tmp_path)))
    with pytest.raises(ValueError):
        union_standard([])


def test_listing_is_in_month_order(spark, raw_folder):
    names = [r["path"][-15:-8] for r in sources.list_files(spark, str(raw_folder)).collect()]
    assert names == ["2011-01", "2018-06", "2018-07", "2023-01", "2023-02"]


def test_oldest_spellings(spark):
    frame = spark.createDataFrame(
        [("2009-01-04 02:52:00", "2009-01-04 03:02:00", 2.63, 9.4, 1)],
        "Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, Trip_Distance double, Total_Amt double, "
        "Passenger_Count int",
    )
    assert rows(standardize(frame)) == [
        (dt.datetime(2009, 1, 4, 2, 52), dt.datetime(2009, 1, 4, 3, 2), None, None, 2.63, 9.4, 1, 0.0)
    ]


def test_text_times_without_zone_ids(spark):
    frame = spark.createDataFrame(
        [("2010-03-26 19:18:00", "junk", "5.5")],
        "pickup_datetime string, dropoff_datetime string, trip_distance string",
    )
    (got,) = standardize(frame).collect()
    assert got["pickup_datetime"] == dt.datetime(2010, 3, 26, 19, 18)
    assert got["dropoff_datetime"] is None and got["PULocationID"] is None
    assert got["trip_distance"] == 5.5 and got["passenger_count"] is None and got["airport_fee"] == 0.0


def test_every_present_spelling_counts(spark):
    session = case_sensitive(spark)
    frame = session.createDataFrame(
        [(None, 2.0, None, 1.25, 3.9), (1.0, 2.0, 0.5, 1.25, 1.0), (None, None, None, None, None)],
        "trip_distance double, Trip_Distance double, airport_fee double, Airport_fee double, passenger_count double",
    )
    got = standardize(frame).select("trip_distance", "airport_fee", "passenger_count")
    assert [tuple(r) for r in got.collect()] == [(2.0, 1.25, 3), (1.0, 0.5, 1), (None, None, None)]


def test_a_null_time_falls_back_to_text(spark):
    frame = spark.createDataFrame(
        [(None, "2012-01-01 00:00:00"), ("2013-01-01 00:00:00", "2012-01-01 00:00:00")],
        "t string, pickup_datetime string",
    ).selectExpr("cast(t as timestamp_ntz) tpep_pickup_datetime", "pickup_datetime")
    got = [r["pickup_datetime"].year for r in standardize(frame).collect()]
    assert got == [2012, 2013]


def test_case_sensitivity_stays_out_of_the_main_session(spark, raw_folder):
    sources.read_eras(spark, str(raw_folder)).count()
    assert spark.conf.get("spark.sql.caseSensitive", "false") == "false"


def test_raw_filters_reach_the_reader(spark, raw_folder):
    from tripweave.operators.quality import clean

    from conftest import plan_text

    plan = plan_text(clean(sources.read_era(spark, MODERN, str(raw_folder), pattern=MODERN.name_pattern())))
    pushed = plan[plan.rindex("PushedFilters") :]
    for condition in (
        "GreaterThan(trip_distance,0.0)",
        "LessThanOrEqual(total_amount,2000.0)",
        "IsNotNull(PULocationID)",
        "GreaterThanOrEqual(tpep_pickup_datetime,2011-01-01T00:00)",
    ):
        assert condition in pushed


def test_era_folders_give_back_the_trips(spark, tmp_path):
    trips = fixtures.order_trips(spark, TINY)
    fixtures.write_era_folders(trips, str(tmp_path))
    stored = fixtures.era_folders(str(tmp_path)).values()
    frames = [sources.read_era(spark, era, path) for era, path in stored]
    expected = trips.withColumn(
        "airport_fee", F.when(F.year("pickup_datetime") <= 2013, 0.0).otherwise(F.col("airport_fee"))
    )
    got = union_standard(frames)
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()
    backwards = union_standard(frames[::-1])
    assert backwards.exceptAll(got).count() == 0 and backwards.count() == got.count()


def test_zone_file(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n2,,x,y\n')
    got = [tuple(r) for r in read_zones(spark, str(tmp_path / "zones.csv")).collect()]
    assert got == [(1, "EWR", "Newark, Airport", "EWR"), (2, None, "x", "y")]
    assert LEGACY.schema["passenger_count"] != MIDDLE.schema["passenger_count"]


def test_every_file_is_read_or_listed(spark, raw_folder, tmp_path):
    """Months beyond the eras, foreign names and damaged files are told, not lost."""
    import shutil

    folder = tmp_path / "all"
    shutil.copytree(raw_folder, folder)
    some = next(str(p) for p in sorted(folder.rglob("*.parquet")))
    for name in ("2009-05", "2025-01", "2030-01"):
        shutil.copy(some, folder / f"{sources.PREFIX}{name}.parquet")
    shutil.copy(some, folder / "other.parquet")
    (folder / f"{sources.PREFIX}2014-02.parquet").write_bytes(b"nothing")
    found = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in sources.left_out(spark, str(folder)).collect()}
    beyond = {f"{sources.PREFIX}{m}.parquet": "a month of no era" for m in ("2009-05", "2025-01", "2030-01")}
    damaged = found.pop(f"{sources.PREFIX}2014-02.parquet")
    assert found == beyond | {"other.parquet": "not named by a month"} and "Arrow" in damaged
    listed = {r["path"].rsplit("/", 1)[1] for r in sources.list_files(spark, str(folder)).collect()}
    assert set(beyond) <= listed


def test_types_that_arrow_names_otherwise(spark, tmp_path):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tripweave.operators.audit import file_schemas

    day = pa.array([dt.datetime(2020, 1, 1)], pa.timestamp("us"))
    wide = pa.table({"a": pa.array([1], pa.uint8()), "b": pa.array([1], pa.uint16()), "c": pa.array([1], pa.uint32()),
                     "d": pa.array([1], pa.uint64()), "t": day})
    pq.write_table(wide, tmp_path / "x.parquet", use_deprecated_int96_timestamps=True)
    files = spark.createDataFrame([(str(tmp_path / "x.parquet"),)], "path string")
    (row,) = file_schemas(files).collect()
    assert row["error"] is None
    stored = {n: t for n, t in spark.read.parquet(str(tmp_path / "x.parquet")).dtypes}
    assert {c.split(" ")[0].strip("`"): c.split(" ")[1] for c in row["schema"].split(", ")} == stored
