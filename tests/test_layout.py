from __future__ import annotations

from pathlib import Path

import __spark_entry__ as entry
from pyspark.sql import functions as F

from tripweave import fixtures
from tripweave.plans.etl import clean_trips
from tripweave.schemas import CLEAN_SCHEMA
from tripweave.sources.trips import read_clean
from tripweave.sources.writers import with_layout_columns, write_bucketed, write_clean, write_compact

from conftest import TINY, plan_text


def unchanged(a, b):
    return a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_round_trip(clean_table, spark, tmp_path):
    flat = clean_table.select(*CLEAN_SCHEMA.names)
    for name, options in {
        "hashed": {"tasks": 4},
        "split": {"tasks": 4, "splits": 3},
        "in_place": {"shuffle": False},
        "zstd": {"compression": "zstd", "max_records_per_file": 20},
    }.items():
        write_clean(flat, str(tmp_path / name), **options)
        assert unchanged(read_clean(spark, str(tmp_path / name)), clean_table), name
    assert list((tmp_path / "zstd").rglob("*.zstd.parquet"))
    assert list((tmp_path / "hashed").rglob("*.snappy.parquet"))


def test_folders(clean_path, clean_table):
    months = {p.parent.parent.name + "/" + p.parent.name for p in Path(clean_path).rglob("*.parquet")}
    expected = {f"year={r[0]}/month={r[1]}" for r in clean_table.select("year", "month").distinct().collect()}
    assert months == expected
    mismatched = clean_table.filter("year <> year(pickup_datetime) OR month <> month(pickup_datetime)")
    assert mismatched.count() == 0


def test_pruned_read(spark, clean_path, clean_table):
    pruned = read_clean(spark, clean_path, (2012, 2013), [3, 4])
    scan = plan_text(pruned)
    scan = scan[scan.rindex("FileScan") :]
    assert "PartitionFilters: [isnotnull(year" in scan and "month" in scan
    assert "PartitionFilters: []" not in scan
    assert unchanged(pruned, clean_table.filter("year IN (2012, 2013) AND month IN (3, 4)"))
    files = pruned.select("_metadata.file_path").distinct().collect()
    assert all("/year=201" in f[0] and ("month=3/" in f[0] or "month=4/" in f[0]) for f in files)


def test_a_timestamp_range_alone_does_not_prune(spark, clean_path):
    by_time = read_clean(spark, clean_path).filter(F.year("pickup_datetime") == 2012)
    assert "PartitionFilters: []" in plan_text(by_time)


def test_replacing_only_new_months(spark, make_trips, zones, tmp_path):
    path = str(tmp_path / "table")
    june = {"pickup": "2019-06-01 10:00:00", "dropoff": "2019-06-01 10:30:00"}
    july = {"pickup": "2019-07-01 10:00:00", "dropoff": "2019-07-01 10:30:00"}
    write_clean(clean_trips(make_trips(june, july), zones), path)
    write_clean(clean_trips(make_trips({**july, "total_amount": 99.0}, july), zones), path, replace_months_only=True)
    counts = {r["month"]: r["count"] for r in read_clean(spark, path).groupBy("month").count().collect()}
    assert counts == {6: 1, 7: 2}
    write_clean(clean_trips(make_trips(july), zones), path)
    assert read_clean(spark, path).count() == 1


def test_compact_files(spark, clean_table, tmp_path):
    for shuffle in (True, False):
        path = tmp_path / f"compact-{shuffle}"
        write_compact(clean_table.repartition(12), str(path), files=3, shuffle=shuffle)
        assert len(list(path.glob("*.parquet"))) == 3
        assert spark.read.parquet(str(path)).count() == clean_table.count()


def test_a_month_with_most_rows_is_split(spark, make_trips, zones, tmp_path):
    amounts = F.explode(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: i / 16))
    july = {"pickup": "2019-07-01 10:00:00", "dropoff": "2019-07-01 10:30:00"}
    hot = make_trips({}).withColumn("total_amount", amounts)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "64KB")
        write_clean(clean_trips(hot.unionByName(make_trips(july)).repartition(16), zones), str(tmp_path / "hot"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "hot/year=2019/month=6").glob("*.parquet"))) > 1
    assert read_clean(spark, str(tmp_path / "hot")).count() == 20_001


def test_layout_shuffles_once_and_rebalances(make_trips, zones):
    table = with_layout_columns(clean_trips(make_trips({}), zones)).hint("rebalance", "year", "month")
    plan = plan_text(table)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_bucketed_table_groups_without_a_shuffle(spark, clean_table):
    write_bucketed(clean_table.select(*CLEAN_SCHEMA.names), "trips_by_borough", 4)
    grouped = spark.table("trips_by_borough").groupBy("pickup_borough").count()
    assert "Exchange" not in plan_text(grouped)
    assert grouped.agg(F.sum("count")).first()[0] == clean_table.count()
    spark.sql("DROP TABLE trips_by_borough")


def test_a_coalesced_write_has_more_files_for_more_trips(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "PIECE_BYTES", 10_000)
    asked, write = [], write_compact
    monkeypatch.setattr(entry.writers, "write_compact", lambda *a, **o: asked.append(o) or write(*a, **o))
    assert entry.coalesced_write(spark, TINY).count() == entry._basic(spark, TINY).count()
    assert asked == [{"files": 12, "shuffle": False}]


def test_line_items_of_many_trips_move_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = fixtures.order_trips(spark, TINY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the nodes above the scan of the line items
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Scan" in line and "l_orderkey#" in line)
    deep, moves = len(lines[at]) - len(lines[at].lstrip(" :+-")), 0
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < deep:
            deep, moves = own, moves + ("Exchange" in line)
    assert moves == 2  # to the orders and to the suppliers
