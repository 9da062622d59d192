"""Readers see a stored table's old version or its new one, whatever dies in between."""

import datetime as dt

import pytest
from helpers import d

from sparkmarts.operators import incremental
from sparkmarts.sources import landing, versions
from sparkmarts.sources.readers import hadoop_path
from sparkmarts.sources.sinks import save_table

SCHEMA = "k bigint, v string, order_date date"
OLD = [(1, "old", d("2024-01-05")), (2, "keep", d("2024-01-06")), (3, "old", d("2024-02-01")), (9, "far", d("2023-05-01"))]
NEW = [(1, "new", d("2024-01-05")), (3, "new", d("2024-03-01")), (4, "new", d("2024-02-09"))]
WAS = sorted((k, v) for k, v, _ in OLD)
WANT = [(1, "new"), (2, "keep"), (3, "new"), (4, "new"), (9, "far")]


class Crash(RuntimeError):
    pass


def _load(spark, path, rows, **options):
    df = incremental.with_month_partition(spark.createDataFrame(rows, SCHEMA))
    return incremental.delete_insert(spark, df, path, ["k"], ["order_month"], **options)


def _rows(spark, path):
    return sorted((r.k, r.v) for r in incremental.read_target(spark, path).collect())


def _files(spark, path):
    fs, p = hadoop_path(spark, path)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        name = str(it.next().getPath())
        if name.endswith(".parquet"):
            found.append(name)
    return found


# every step of a load, and what has been done when it dies there
POINTS = ["_write_partitioned", "second _write_partitioned", "partition_folders", "read_version", "commit", "after commit"]


@pytest.mark.parametrize("point", POINTS)
def test_reader_between_a_crash_and_the_next_load(spark, scratch, monkeypatch, point):
    path = scratch("crash")
    _load(spark, path, OLD)
    with monkeypatch.context() as m:
        calls = []
        where = incremental if "write" in point else versions
        name = point.split()[-1]
        real = getattr(where, name)

        def dying(*a, **k):
            calls.append(1)
            if point == "after commit":
                real(*a, **k)
                raise Crash
            if point.startswith("second") and len(calls) == 1:
                return real(*a, **k)
            raise Crash

        m.setattr(where, name, dying)
        m.setattr(versions, "drop_load", lambda *a: None)  # a killed process cleans nothing up
        with pytest.raises(Crash):
            _load(spark, path, NEW)
    assert _rows(spark, path) == (WANT if point == "after commit" else WAS)
    _load(spark, path, NEW)
    assert _rows(spark, path) == WANT
    # what the dead load left is deleted in time, and nothing else
    versions.vacuum(spark, path, keep=1, older_than=dt.timedelta(0))
    assert _rows(spark, path) == WANT
    named = versions.current(spark, path).paths(path)
    assert all(any(f"{p.split('_data/')[1]}/" in f for p in named) for f in _files(spark, path))


def test_every_row_is_written_once(spark, scratch, monkeypatch):
    path = scratch("once")
    _load(spark, path, OLD)
    before = len(_files(spark, path))
    written = []
    real = incremental._write_partitioned
    monkeypatch.setattr(incremental, "_write_partitioned", lambda df, *a: (written.append(df.count()), real(df, *a)))
    info = _load(spark, path, NEW)
    assert info["mode"] == "delete+insert" and written == [3, 1]  # the batch, and the one row kept in its months
    assert before < len(_files(spark, path)) <= before + 4
    assert "order_month=2023-05" in versions.current(spark, path).parts  # untouched: still the first load's files


def test_old_version_stays_readable(spark, scratch):
    path = scratch("old")
    _load(spark, path, OLD)
    reader = incremental.read_target(spark, path)
    _load(spark, path, NEW)
    assert sorted((r.k, r.v) for r in reader.collect()) == WAS
    assert _rows(spark, path) == WANT


def test_of_two_writers_one_wins(spark, scratch, monkeypatch):
    path = scratch("race")
    _load(spark, path, OLD)
    real = versions.commit

    def late(s, p, made, parent):
        with monkeypatch.context() as inner:
            inner.setattr(versions, "commit", real)
            _load(spark, path, [(5, "other", d("2024-01-09"))])
        return real(s, p, made, parent)

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", late)
        with pytest.raises(versions.LostRace):
            _load(spark, path, NEW)
    assert _rows(spark, path) == sorted([*WAS, (5, "other")])
    _load(spark, path, NEW)
    assert _rows(spark, path) == sorted([*WANT, (5, "other")])


def test_full_refresh_is_one_switch(spark, scratch, monkeypatch):
    path = scratch("refresh")
    _load(spark, path, OLD)
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            _load(spark, path, NEW, full_refresh=True)
    assert _rows(spark, path) == WAS
    _load(spark, path, NEW, full_refresh=True)
    assert _rows(spark, path) == [(1, "new"), (3, "new"), (4, "new")]


def test_a_first_write_that_died_counts_as_none(spark, scratch):
    path = scratch("first")
    fs, p = hadoop_path(spark, f"{path}/_temporary/0")
    fs.mkdirs(p)
    assert incremental.read_target(spark, path) is None
    _load(spark, path, OLD)
    assert len(_rows(spark, path)) == 4
    root = scratch("land")
    fs, p = hadoop_path(spark, f"{root}/nation.parquet/_temporary/0")
    fs.mkdirs(p)
    assert landing.land_tables(spark, "/root/testdata/sf0.001", root, ["nation"]) == [("nation", "created")]


def _plain(spark, path, rows):
    df = incremental.with_month_partition(spark.createDataFrame(rows, SCHEMA))
    df.write.partitionBy("order_month").parquet(path)


def test_a_plain_table_is_taken_over(spark, scratch):
    path = scratch("plain")
    _plain(spark, path, OLD)
    assert _rows(spark, path) == WAS
    _load(spark, path, NEW)
    assert _rows(spark, path) == WANT
    assert all("/_data/" in f for f in _files(spark, path))


def test_data_without_the_mark_of_a_finished_write_is_refused(spark, scratch):
    path = scratch("half")
    _plain(spark, path, OLD)
    fs, p = hadoop_path(spark, f"{path}/_SUCCESS")
    fs.delete(p, False)
    with pytest.raises(versions.HalfWritten):
        _load(spark, path, NEW)


def test_full_replace_drops_old_partitions(spark, scratch):
    path = scratch("save")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    save_table(df, path, ["p"])
    save_table(df.where("p = 'a'"), path, ["p"])
    assert [r.p for r in versions.read_table(spark, path).collect()] == ["a"]


@pytest.mark.parametrize("method", landing.RELOAD_METHODS)
def test_a_reload_that_dies_leaves_the_old_table(spark, scratch, monkeypatch, method):
    src, dst = scratch("src"), scratch("dst")
    save_table(spark.range(5).withColumnRenamed("id", "r_regionkey"), f"{src}/region.parquet")
    landing.land_tables(spark, src, dst, ["region"])
    save_table(spark.range(7).withColumnRenamed("id", "r_regionkey"), f"{src}/region.parquet")
    count = lambda: versions.read_table(spark, f"{dst}/region.parquet").count()
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            landing.reload_table(spark, src, dst, ["region"], method)
    assert count() == 5
    landing.reload_table(spark, src, dst, ["region"], method)
    assert count() == 7


def test_appends_are_given_keys_once(spark, scratch, monkeypatch):
    path = scratch("append")
    save_table(spark.range(1, 11).withColumnRenamed("id", "k"), path)
    batch = spark.createDataFrame([(f"r{i}",) for i in range(5)], "v string")
    now = dt.datetime(2024, 1, 1)
    # the caller dies after the version was made, and repeats the batch
    real = versions.commit
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (real(*a), (_ for _ in ()).throw(Crash())))
        with pytest.raises(Crash):
            landing.append_with_next_keys(spark, path, batch, "k", now, ["v"], batch_id="b1")
    assert landing.append_with_next_keys(spark, path, batch, "k", now, ["v"], batch_id="b1") == {"first_key": 11, "appended": False}
    # another writer appends between our read of the last key and our commit
    def late(*a):
        with monkeypatch.context() as inner:
            inner.setattr(versions, "commit", real)
            landing.append_with_next_keys(spark, path, batch, "k", now, ["v"], batch_id="other")
        m2.setattr(versions, "commit", real)
        return real(*a)

    with monkeypatch.context() as m2:
        m2.setattr(versions, "commit", late)
        got = landing.append_with_next_keys(spark, path, batch, "k", now, ["v"], batch_id="b2")
    assert got == {"first_key": 21, "appended": True}
    rows = versions.read_table(spark, path).collect()
    assert sorted(r.k for r in rows) == list(range(1, 26))
    assert {r.v for r in rows if r.k <= 10} == {None}  # older rows lack the batch's columns


def test_order_stream_loads_every_order(spark, scratch):
    """Files with overlapping dates, one a micro-batch, the first one empty."""
    from conftest import SMOKE_DIR

    from sparkmarts.plans.warehouse import Warehouse
    from sparkmarts.streaming.arrivals import start_order_fact_stream

    wh = Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True)
    raw = wh.raw("orders").where("o_orderkey % 8 = 0")
    landing_dir, out = scratch("arrive"), scratch("facts")
    raw.where("false").coalesce(1).write.parquet(landing_dir)
    for k in (0, 8):
        raw.where(f"o_orderkey % 16 = {k}").coalesce(1).write.mode("append").parquet(landing_dir)
    q = start_order_fact_stream(spark, wh, landing_dir, out, scratch("ck"), max_files_per_trigger=1)
    q.awaitTermination()
    stored = incremental.read_fact(spark, f"{out}/fct_orders")
    want = wh.fct_orders.where("order_key % 8 = 0")
    assert stored.count() == raw.count()
    assert stored.exceptAll(want.select(*stored.columns)).count() == 0
    items = incremental.read_fact(spark, f"{out}/fct_order_items")
    assert items.count() == wh.fct_order_items.where("order_key % 8 = 0").count()
