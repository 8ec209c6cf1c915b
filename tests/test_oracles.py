"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import re
import sys
from datetime import UTC, timedelta
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

from conftest import TINY  # noqa: E402

ONE_MINUTE = timedelta(minutes=1)


@pytest.fixture(scope="module")
def connection():
    return compare.connect(TINY)


@pytest.mark.parametrize("name", sorted(entry.oracles.statements()))
def test_query_matches_sql(spark, connection, name):
    assert compare.spark_side(spark, TINY, name) == compare.oracle_side(connection, name)


def test_queries_without_sql():
    own = {name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own - set(entry.oracle_sql()) == {"schema_drift"}


def test_elapsed_duration(spark):
    zone = ZoneInfo("America/New_York")
    shifted = 0
    for start, end, minutes in entry.queries()["elapsed_duration"](spark, TINY).collect():
        elapsed = (end.replace(tzinfo=zone).astimezone(UTC) - start.replace(tzinfo=zone).astimezone(UTC)) / ONE_MINUTE
        exact = Decimal(round(elapsed * 60)) / 60  # the fixture has whole seconds
        assert minutes == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
        shifted += elapsed != (end - start) / ONE_MINUTE
    assert shifted


def test_schema_drift(spark):
    runs = entry.queries()["schema_drift"](spark, TINY).collect()
    assert [r["run"] for r in runs] == [1, 2, 3, 4]


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() == 4 and "avg_fare" in result.columns
