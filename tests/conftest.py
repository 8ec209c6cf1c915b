from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave.plans.etl import clean_trips  # noqa: E402
from tripweave.schemas import TRIP_SCHEMA, ZONE_SCHEMA  # noqa: E402
from tripweave.session import build_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__session__timeZone="UTC",
        spark__sql__maxMetadataStringLength="20000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def zones(spark):
    rows = [
        (1, "EWR", "Newark Airport", "EWR"),
        (4, "Manhattan", "Alphabet City", "Yellow Zone"),
        (7, "Queens", "Astoria", "Boro Zone"),
        (264, "Unknown", "N/A", "N/A"),
        (265, "N/A", "Outside", "N/A"),
        (266, None, "Nowhere", None),
    ]
    return spark.createDataFrame(rows, ZONE_SCHEMA)


@pytest.fixture(scope="session")
def make_trips(spark):
    """Trips from dicts; anything not given is an ordinary valid value."""

    def make(*overrides):
        base = {
            "pickup": "2019-06-05 10:00:00",
            "dropoff": "2019-06-05 10:30:00",
            "PULocationID": 4,
            "DOLocationID": 7,
            "trip_distance": 3.0,
            "total_amount": 20.0,
            "passenger_count": 1,
            "airport_fee": 0.0,
        }
        rows = [tuple({**base, **o}.values()) for o in overrides]
        ddl = (
            "pickup string, dropoff string, PULocationID long, DOLocationID long, trip_distance double, "
            "total_amount double, passenger_count int, airport_fee double"
        )
        frame = spark.createDataFrame(rows, ddl)
        return frame.selectExpr(
            "cast(pickup as timestamp_ntz) pickup_datetime",
            "cast(dropoff as timestamp_ntz) dropoff_datetime",
            *TRIP_SCHEMA.names[2:],
        )

    return make


@pytest.fixture(scope="session")
def clean_path(spark, tmp_path_factory):
    """The cleaned table derived from the smallest driver tables, written once."""
    from tripweave import fixtures
    from tripweave.sources.writers import write_clean

    path = str(tmp_path_factory.mktemp("clean") / "table")
    write_clean(clean_trips(fixtures.order_trips(spark, TINY), fixtures.nation_zones(spark, TINY)), path)
    return path


@pytest.fixture(scope="session")
def clean_table(spark, clean_path):
    from tripweave.sources.trips import read_clean

    return read_clean(spark, clean_path)


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()
