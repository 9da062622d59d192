import datetime as dt

import pytest
from helpers import D
from pyspark.sql import functions as F

from sparkmarts.operators import snapshots
from sparkmarts.sources import versions

SCHEMA = "customer_key bigint, customer_address string, phone_number string, account_balance decimal(12,2), market_segment string"
T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
CHECK = ["account_balance", "market_segment", "customer_address"]


def _apply(spark, path, rows, ts):
    snapshots.snapshot_check(spark, spark.createDataFrame(rows, SCHEMA), path, "customer_key", CHECK, ts)


def test_scd2_rules(spark, scratch):
    path = scratch("snp")
    _apply(spark, path, [
        (1, "a", "p", D("1.00"), "S"),  # no change
        (2, "a", "p", D("1.00"), "S"),  # balance change
        (3, "a", "p", D("1.00"), "S"),  # phone change only
        (4, "a", "p", None, "S"),  # NULL -> value
        (6, "a", "p", D("1.00"), "S"),  # missing later
    ], T1)
    second = [
        (1, "a", "p", D("1.00"), "S"),
        (2, "a", "p", D("2.00"), "S"),
        (3, "a", "q", D("1.00"), "S"),
        (4, "a", "p", D("3.00"), "S"),
        (5, "a", "p", D("1.00"), "S"),  # new key
    ]
    _apply(spark, path, second, T2)
    rows = snapshots.read_snapshot(spark, path).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.customer_key, []).append(r)
    assert len(by_key[1]) == 1 and by_key[1][0].valid_to is None
    assert len(by_key[3]) == 1 and by_key[3][0].phone_number == "p"  # non-check change opens nothing
    for k in (2, 4):
        versions = sorted(by_key[k], key=lambda r: r.valid_from)
        assert len(versions) == 2
        assert versions[0].valid_to == versions[1].valid_from == T2
        assert versions[1].valid_to is None
    assert len(by_key[5]) == 1 and by_key[5][0].valid_from == T2
    assert len(by_key[6]) == 1 and by_key[6][0].valid_to is None  # missing key stays open
    assert len({r.scd_id for r in rows}) == len(rows)

    # the same load again opens nothing new
    _apply(spark, path, second, T3)
    assert snapshots.read_snapshot(spark, path).count() == len(rows)


def test_load_time_must_not_go_back(spark, scratch):
    path = scratch("snp-time")
    _apply(spark, path, [(1, "a", "p", D("1.00"), "S")], T2)
    with pytest.raises(ValueError):
        _apply(spark, path, [(1, "a", "p", D("2.00"), "S")], T1)
    with pytest.raises(ValueError):  # a different load with the same time
        _apply(spark, path, [(1, "a", "p", D("2.00"), "S")], T2)
    _apply(spark, path, [(1, "a", "p", D("1.00"), "S")], T2)  # the same load again: no-op
    assert snapshots.read_snapshot(spark, path).count() == 1


def test_two_loads_in_one_second(spark, scratch):
    path = scratch("snp-second")
    t = [dt.datetime(2024, 1, 1, 0, 0, 0, us) for us in (0, 100_000, 600_000)]
    for i, ts in enumerate(t):
        _apply(spark, path, [(1, "a", "p", D(f"{i}.00"), "S")], ts)
    rows = sorted(snapshots.read_snapshot(spark, path).collect(), key=lambda r: r.valid_from)
    assert [(r.account_balance, r.valid_from, r.valid_to) for r in rows] == [
        (D("0.00"), t[0], t[1]), (D("1.00"), t[1], t[2]), (D("2.00"), t[2], None)
    ]
    assert len({r.scd_id for r in rows}) == 3


@pytest.mark.parametrize("bad", [[(None, "a", "p", None, "S")], [(1, "a", "p", None, "S"), (1, "b", "p", None, "S")]])
def test_null_and_repeated_keys_are_refused(spark, scratch, bad):
    path = scratch("snp-bad")
    with pytest.raises(snapshots.BadKeys):
        _apply(spark, path, bad, T1)
    _apply(spark, path, [(1, "a", "p", None, "S")], T1)
    with pytest.raises(snapshots.BadKeys):
        _apply(spark, path, bad, T2)
    assert snapshots.read_snapshot(spark, path).count() == 1


def _history(spark, path):
    return sorted(snapshots.read_snapshot(spark, path).collect(), key=lambda r: (r.customer_key, r.valid_from))


def test_a_load_writes_only_what_changed(spark, scratch):
    path = scratch("snp-small")
    rows = [(i, "a", "p", D("1.00"), "S") for i in range(50)]
    _apply(spark, path, rows, T1)
    _apply(spark, path, [(0, "b", "p", D("1.00"), "S"), *rows[1:]], T2)
    version = versions.current(spark, path)
    (change,) = version.parts["_state=change"]
    assert spark.read.parquet(versions.load_path(path, change)).count() == 1
    assert len(version.parts["_state=open"]) == 1  # the first load's files
    _apply(spark, path, [(0, "b", "p", D("1.00"), "S"), *rows[1:]], T3)
    assert versions.current(spark, path).number == version.number  # nothing changed: no version


def test_compaction_keeps_the_contents(spark, scratch):
    path, plain = scratch("snp-compact"), scratch("snp-never")
    for i in range(5):
        rows = [(k, f"a{i * k // 3}", "p", D("1.00"), "S") for k in range(i, 6 + i)]
        for p, n in ((path, 2), (plain, 99)):
            snapshots.snapshot_check(spark, spark.createDataFrame(rows, SCHEMA), p, "customer_key", CHECK, dt.datetime(2024, 1, 1 + i), compact_after=n)
    assert "_state=closed" in versions.current(spark, path).parts
    assert _history(spark, path) == _history(spark, plain)
    snapshots.compact(spark, path)
    assert not snapshots.compact(spark, path)
    assert _history(spark, path) == _history(spark, plain)


def test_a_load_that_dies_changes_nothing(spark, scratch, monkeypatch):
    path = scratch("snp-crash")
    _apply(spark, path, [(1, "a", "p", None, "S")], T1)
    before = _history(spark, path)
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            _apply(spark, path, [(1, "b", "p", None, "S")], T2)
    assert _history(spark, path) == before
    _apply(spark, path, [(1, "b", "p", None, "S")], T2)
    assert [(r.customer_address, r.valid_to) for r in _history(spark, path)] == [("a", T2), ("b", None)]


def test_history_of_an_older_release_is_taken_over(spark, scratch):
    path, other = scratch("snp-plain"), scratch("snp-new")
    for rows, t in (([(1, "a", "p", None, "S"), (2, "a", "p", None, "S")], T1), ([(1, "b", "p", None, "S")], T2)):
        _apply(spark, other, rows, t)
    state = F.when(F.col("valid_to").isNull(), "current").otherwise("closed_20240102T000000000000")
    snapshots.read_snapshot(spark, other).withColumn("_state", state).write.partitionBy("_state").parquet(path)
    assert _history(spark, path) == _history(spark, other)
    for p in (path, other):
        _apply(spark, p, [(2, "c", "p", None, "S")], T3)
    assert _history(spark, path) == _history(spark, other)


def test_one_join_free_pass_per_load(spark, scratch):
    """A load's plan shuffles the stored versions and the extract once, by key, and joins nothing."""
    path = scratch("snp-plan")
    _apply(spark, path, [(1, "a", "p", None, "S")], T1)
    version = versions.current(spark, path)
    new = spark.createDataFrame([(1, "b", "p", None, "S")], SCHEMA)
    found = snapshots._by_key(new, versions.read_version(spark, path, version), "customer_key", CHECK)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
