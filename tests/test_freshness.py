import datetime as dt

from sparkmarts.operators import freshness
from sparkmarts.settings import Freshness

SCHEMA = "ts timestamp_ntz, kind string"
NOW = dt.datetime(2024, 1, 3, 0, 0, 0)


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_status_thresholds_and_filter(spark):
    df = _rows(spark, [(dt.datetime(2024, 1, 1, 0, 0, 0), "a"), (dt.datetime(2024, 1, 2, 12, 0, 0), "b")])
    th = Freshness(24, 48)
    r = freshness.freshness_by_column(df, "t", "ts", NOW, th).collect()[0]
    assert r.max_loaded_at == dt.datetime(2024, 1, 2, 12) and r.age_hours == 12.0 and r.status == "pass"
    r = freshness.freshness_by_column(df, "t", "ts", NOW, th, where="kind = 'a'").collect()[0]
    assert r.age_hours == 48.0 and r.status == "warn"  # exactly at the error threshold: not older
    r = freshness.freshness_by_column(df, "t", "ts", NOW, Freshness(12, 24), where="kind = 'a'").collect()[0]
    assert r.status == "error"


def test_empty_table_is_error(spark):
    r = freshness.freshness_by_column(_rows(spark, []), "t", "ts", NOW, Freshness(1, 2)).collect()[0]
    assert r.max_loaded_at is None and r.status == "error"


def test_by_file_metadata(spark, scratch):
    path = scratch("fresh")
    _rows(spark, [(dt.datetime(2024, 1, 1), "a")]).write.parquet(path)
    far_future = dt.datetime(2200, 1, 1)
    r = freshness.freshness_by_files(spark, path, "t", far_future, Freshness(24, 72)).collect()[0]
    assert r.max_loaded_at is not None and r.status == "error"
    r = freshness.freshness_by_files(spark, path, "t", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1), Freshness(24, 72)).collect()[0]
    assert r.status == "pass"


def test_cli_freshness(spark, capsys):
    from conftest import SMOKE_DIR

    from sparkmarts.__main__ import main

    assert main(["freshness", SMOKE_DIR, "--now", "2200-01-01T00:00:00"]) == 0
    out = capsys.readouterr().out
    assert "lineitem" in out and "error" in out  # files are far older than 72 hours by then
