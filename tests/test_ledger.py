"""Footers fetched and parsed apart, runs over many tasks, and the ledger from run to run."""

from __future__ import annotations

import errno
import os
import random
from collections import Counter

import __spark_entry__ as entry
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripweave.operators import audit
from tripweave.sources import ledger, snapshots
from tripweave.sources import trips as sources

from conftest import TINY, plan_text

LONG, DOUBLE = pa.int64(), pa.float64()


def month_file(folder, name, kind=LONG, value=1, column="passenger_count"):
    pq.write_table(pa.table({column: pa.array([value], kind)}), f"{folder}/{name}.parquet")


def file(month):
    return f"{sources.PREFIX}{month}"


def verdict_of(path, open_file, list_all=False):
    import pandas as pd

    footers = audit._footer

    def opened(path, tail, length, _=None):
        return footers(path, tail, length, open_file)

    audit._footer = opened
    try:
        (found,) = audit._footers(iter([pd.DataFrame({"path": [path]})]), list_all)
    finally:
        audit._footer = footers
    return found["verdict"][0]


class Broken:
    """A store that fails a number of times before it answers."""

    def __init__(self, problem, times):
        self.problem, self.left = problem, times

    def __call__(self, path):
        if self.left:
            self.left -= 1
            raise self.problem
        return audit._opened(path)


@pytest.fixture(autouse=True)
def no_waiting(monkeypatch):
    monkeypatch.setattr("time.sleep", lambda seconds: None)


def test_a_connection_that_fails_is_tried_again(tmp_path):
    month_file(tmp_path, "a")
    path = str(tmp_path / "a.parquet")
    for problem in (OSError("timeout"), ConnectionResetError(errno.ECONNRESET, "reset"), FileNotFoundError("gone")):
        assert verdict_of(path, Broken(problem, audit.ATTEMPTS - 1)) == audit.SOUND
        with pytest.raises(audit.FileUnreachable, match="a.parquet"):
            verdict_of(path, Broken(problem, audit.ATTEMPTS))
        assert verdict_of(path, Broken(problem, audit.ATTEMPTS), list_all=True) == audit.UNREACHABLE


def test_a_refusal_is_not_damage(tmp_path):
    month_file(tmp_path, "a")
    path = str(tmp_path / "a.parquet")
    for problem in (PermissionError("no"), OSError("AWS Error ACCESS_DENIED during HeadObject"), OSError("HTTP status 403")):
        with pytest.raises(audit.FileRefused):
            verdict_of(path, Broken(problem, 1))
        assert verdict_of(path, Broken(problem, 1), list_all=True) == audit.REFUSED


@pytest.mark.parametrize("cut", [0, 5, 11, 12, 100, -1, -3, -9])
def test_damage_is_what_the_bytes_say(tmp_path, cut):
    month_file(tmp_path, "a")
    path = tmp_path / "a.parquet"
    path.write_bytes(path.read_bytes()[:cut])
    assert verdict_of(str(path), None) == audit.DAMAGED
    month_file(tmp_path, "b")
    data = bytearray((tmp_path / "b.parquet").read_bytes())
    data[-8:-4] = (2**31 - 1).to_bytes(4, "little")
    path.write_bytes(bytes(data))
    assert verdict_of(str(path), None) == audit.DAMAGED
    path.write_bytes(b"PAR1" + bytes(200) + (100).to_bytes(4, "little") + b"PAR1")
    assert verdict_of(str(path), None) == audit.DAMAGED


def test_a_long_footer_takes_a_second_read(tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "TAIL_BYTES", 100)
    month_file(tmp_path, "a")
    assert verdict_of(str(tmp_path / "a.parquet"), None) == audit.SOUND


def test_an_unreachable_file_fails_the_job(spark, tmp_path):
    month_file(tmp_path, file("2018-01"))
    files = sources.list_files(spark, str(tmp_path)).select("path").collect()
    gone = spark.createDataFrame([*files, (f"{tmp_path}/gone.parquet",)], "path string")
    with pytest.raises(Exception, match="FileUnreachable"):
        audit.file_schemas(gone).collect()
    listed = {r["verdict"] for r in audit.file_schemas(gone, list_unreachable=True).collect()}
    assert listed == {audit.SOUND, audit.UNREACHABLE}


def test_files_that_only_spark_can_open(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.months.link./in", f"file://{tmp_path}")
    month_file(tmp_path, file("2018-01"))
    month_file(tmp_path, file("2018-02"), DOUBLE)
    (tmp_path / f"{file('2018-03')}.parquet").write_bytes(b"cut")
    files = sources.list_files(spark, "viewfs://months/in")
    found = {r["path"][-15:-8]: r["verdict"] for r in audit.file_schemas(files).collect()}
    assert found == {"2018-01": "sound", "2018-02": "sound", "2018-03": "damaged"}
    trips, rejects = sources.read_drifting(spark, files)
    assert trips.count() == 2 and rejects.count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_any_spread(spark, seed):
    rng = random.Random(seed)
    kinds = [rng.choice("ab" if seed else "a") for _ in range(60)]
    rows = [(f"/x/{i:03d}", None if rng.random() < 0.1 else k) for i, k in enumerate(kinds)]
    expected, last = [], None
    for path, kind in rows:
        if kind is None:
            continue
        if kind != last:
            expected.append([len(expected) + 1, path, path, 0, kind])
        expected[-1][2], last = path, kind
        expected[-1][3] += 1
    known = spark.createDataFrame(rows, "path string, schema string")
    for tasks in (1, 7, 40, 100):
        got = audit.schema_runs(known.repartition(5), tasks).collect()
        assert [list(r) for r in got] == expected


def test_runs_need_no_single_task(spark):
    known = spark.createDataFrame([(f"/x/{i}", str(i)) for i in range(20)], "path string, schema string")
    plan = plan_text(audit.schema_runs(known))
    assert "SinglePartition" not in plan and "Window" not in plan
    assert audit.schema_runs(known.limit(0)).count() == 0


def test_groups_of_files_are_told_shortly(spark, tmp_path):
    rows = [(f"{tmp_path}/even/{file(f'2011-{m:02d}')}.parquet", "a") for m in range(1, 13)]
    rows += [(f"{tmp_path}/odd/{file(f'{y}-{m:02d}')}.parquet", "a" if y < 2013 or m < 7 else "b") for y in (2012, 2013) for m in range(1, 13)]
    rows += [(f"{tmp_path}/odd/{file('2013-12')}-more.parquet", "a"), (f"{tmp_path}/odd/{file('2014-01')}.parquet", None)]
    got = {(r["schema"], r["folder"].rsplit("/", 1)[1]): (r["names"], r["files"]) for r in sources.scan_groups(spark.createDataFrame(rows, "path string, schema string")).collect()}
    assert got["a", "even"] == ([], 12)
    months = [f"{file(f'2013-{m:02d}')}*" for m in range(1, 7)]
    assert got["a", "odd"] == ([f"{file('2012')}*", *months, f"{file('2013-12')}-more.parquet"], 19)
    assert got["b", "odd"] == ([*[f"{file(f'2013-{m:02d}')}*" for m in range(7, 12)], f"{file('2013-12')}.parquet"], 6)


def test_only_listed_files_are_read(spark, tmp_path):
    for n, name in enumerate((file("2018-01"), file("2018-02"), file("2018-02") + "-more", "other{,}[x]")):
        month_file(tmp_path, name, value=n)
    wide = sources.list_files(spark, str(tmp_path), "*.parquet")
    for listed in (wide, wide.where("path NOT LIKE '%other%'"), wide.where("path LIKE '%18-02.par%'"), wide.where("path LIKE '%other%'")):
        trips, _ = sources.read_drifting(spark, listed)
        assert trips.count() == listed.count()


def opened(monkeypatch):
    """Counts the files whose footers are asked for."""
    asked = []
    kept = audit.file_schemas

    def counting(files, *rest, **named):
        asked.append(files.count())
        return kept(files, *rest, **named)

    monkeypatch.setattr(ledger, "file_schemas", counting)
    return asked


def test_a_second_run_opens_new_files_only(spark, tmp_path, monkeypatch):
    raw, kept = tmp_path / "raw", str(tmp_path / "ledger")
    raw.mkdir()
    for month in ("2011-01", "2018-07", "2030-01"):
        month_file(raw, file(month), DOUBLE if month == "2018-07" else LONG)
    (raw / f"{file('2012-01')}.parquet").write_bytes(b"cut")
    month_file(raw, "other")
    asked = opened(monkeypatch)
    first = ledger.update(spark, str(raw), kept)
    rows = {os.path.basename(r["path"])[:-8]: r for r in first.collect()}
    assert {n.removeprefix(sources.PREFIX): (r["era"], r["verdict"]) for n, r in rows.items()} == {
        "2011-01": ("legacy", "sound"),
        "2018-07": ("middle", "sound"),
        "2030-01": (None, "sound"),
        "2012-01": ("legacy", "damaged"),
        "other": (None, "sound"),
    }
    assert rows[file("2011-01")]["schema_hash"] == rows["other"]["schema_hash"] != rows[file("2018-07")]["schema_hash"]
    left = Counter(r["reason"] for r in ledger.remainder(first).collect())
    assert left == {"damaged": 1, "not named by a month": 1, "a month of no era": 1}
    again = ledger.update(spark, str(raw), kept)
    assert snapshots.versions(spark, kept) == [0] and again.count() == 5
    month_file(raw, file("2012-01"), value=7)  # mended
    month_file(raw, file("2012-02"))
    (raw / "other.parquet").unlink()
    third = ledger.update(spark, str(raw), kept)
    assert asked == [5, 0, 2]
    assert third.count() == 5 and ledger.remainder(third).count() == 1
    change = {os.path.basename(r["path"])[:-8]: r["change"] for r in ledger.changes(first, third).collect()}
    assert change == {file("2012-01"): "changed", file("2012-02"): "added", "other": "removed"}
    trips, rejects = sources.read_drifting(spark, third)
    assert trips.count() == 5 and rejects.count() == 0


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert snapshots.versions(spark, path) == [] and snapshots.read(spark, path, "x int").count() == 0
    for n in range(4):
        assert snapshots.commit(spark.range(n).selectExpr("cast(id AS int) AS x"), path) == n
    assert snapshots.versions(spark, path) == [2, 3] and snapshots.read(spark, path, "x int").count() == 3
    os.remove(f"{path}/v=3/_SUCCESS")  # as if the writer had died
    assert snapshots.read(spark, path, "x int").count() == 2
    assert snapshots.commit(spark.range(9).selectExpr("cast(id AS int) AS x"), path) == 4
    assert snapshots.children(spark, path) == ["v=2", "v=4"]


def test_damaged_months_come_from_the_stored_trips(spark, monkeypatch):
    made = []
    monkeypatch.setattr(entry, "_month_roots", {})
    raw = entry._raw
    monkeypatch.setattr(entry, "_raw", lambda *a: made.append(a) or raw(*a))
    assert entry.ingest_remainder(spark, TINY).count() > 0
    assert len(made) == 1
