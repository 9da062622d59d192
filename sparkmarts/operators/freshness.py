"""Source freshness: how old is the newest data of a table?

By a load-time column (``max(column)``, optionally over a row filter) or, for
tables without one, by storage metadata (the newest file modification time). The clock
is passed in, so runs are repeatable. Ages are compared in whole
microseconds: status is ``error`` when older than the error threshold,
``warn`` when older than the warn threshold, else ``pass``; a table without
rows is ``error``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmarts.settings import DEFAULT_SETTINGS, Freshness
from sparkmarts.sources import versions
from sparkmarts.sources.readers import read_source, source_path

HOUR_US = 3_600_000_000

FRESHNESS_COLUMNS = [
    "source_name", "max_loaded_at", "snapshotted_at", "age_hours",
    "warn_after_hours", "error_after_hours", "status",
]


def _now(now: dt.datetime) -> Column:
    return F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _classify(latest: DataFrame, name: str, now: dt.datetime, thresholds: Freshness) -> DataFrame:
    age_us = F.unix_micros(_now(now).cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))
    status = (
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age_us > F.lit(int(thresholds.error_after_hours * HOUR_US)), F.lit("error"))
        .when(age_us > F.lit(int(thresholds.warn_after_hours * HOUR_US)), F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return latest.select(
        F.lit(name).alias("source_name"),
        "max_loaded_at",
        _now(now).alias("snapshotted_at"),
        (age_us.cast("double") / F.lit(float(HOUR_US))).alias("age_hours"),
        F.lit(float(thresholds.warn_after_hours)).alias("warn_after_hours"),
        F.lit(float(thresholds.error_after_hours)).alias("error_after_hours"),
        status.alias("status"),
    )


def freshness_by_column(
    df: DataFrame,
    name: str,
    column: str,
    now: dt.datetime,
    thresholds: Freshness,
    where: str | Column | None = None,
) -> DataFrame:
    """One row: newest ``column`` value (after ``where``), its age and status."""
    src = df if where is None else df.where(where)
    latest = src.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("max_loaded_at"))
    return _classify(latest, name, now, thresholds)


def freshness_by_files(spark: SparkSession, path: str, name: str, now: dt.datetime, thresholds: Freshness) -> DataFrame:
    """One row from the modification times of the table's files (of its current
    version, if it has versions): a listing, no data file is opened."""
    version = versions.current(spark, path)
    paths = [path] if version is None else version.paths(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    latest = files.load(paths).agg(F.max(F.col("modificationTime").cast("timestamp_ntz")).alias("max_loaded_at"))
    return _classify(latest, name, now, thresholds)


def freshness_report(
    spark: SparkSession,
    root: str,
    tables: list[str],
    now: dt.datetime,
    loaded_at: dict[str, tuple[str, str | None]] | None = None,
    settings=DEFAULT_SETTINGS,
) -> DataFrame:
    """One row per table: by ``loaded_at[table] = (column, filter)``, by
    default that of the settings where the table has the column, else by its
    files; always with the table's own thresholds."""
    rows = []
    for t in tables:
        th = settings.table_freshness.get(t, settings.default_freshness)
        df = read_source(spark, root, t)
        col, flt = (loaded_at or {}).get(t) or settings.table_loaded_at.get(t, (None, None))
        if t in (loaded_at or {}) or col in df.columns:
            rows.append(freshness_by_column(df, t, col, now, th, flt))
        else:
            rows.append(freshness_by_files(spark, source_path(root, t), t, now, th))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
