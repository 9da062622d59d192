"""Incremental loading: batch selection and keyed delete+insert.

Targets are Parquet tables partitioned by month, stored in versions (see
:mod:`sparkmarts.sources.versions`). Built-in Parquet tables do not support MERGE
or DELETE, so a keyed replacement rewrites only the touched partitions:

1. the batch is written once, as the files of a new load (this cuts its lineage, too: the
   later steps read it back);
2. touched partitions = partitions of the batch, plus other partitions holding
   target rows whose key occurs in the batch (a key may move between months);
3. the rows of the touched partitions whose key is not in the batch (left anti
   join) are added to the load;
4. one small file makes the next version, in which the touched partitions consist of the new
   load. Until then readers see the old version whole, and a load that dies has changed nothing. A touched
   partition left without rows is no longer named.

Steps 1 and 3 go through large batches and targets in ranges of the key, one after the other, and
the shuffle files of a range are deleted before the next begins: the disk that a load needs besides its own
files is bounded by a range, whatever the table holds.

Every row is written once. Of two loads that ran at the same time, the later to finish fails
with ``LostRace`` and changes nothing.

Semantics kept on purpose: NULL keys never match, so such rows are appended
again; duplicate keys inside a batch are all inserted; the high-water mark is
strict (rows on the maximum date are not loaded); an existing but empty
target loads nothing."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.errors import AnalysisException

from sparkmarts.functions.joins import leaf_bytes
from sparkmarts.session import shuffles_cleared
from sparkmarts.sources import versions
from sparkmarts.sources.readers import list_partition_dirs

log = logging.getLogger(__name__)

MONTH_PARTITION = "order_month"

#: a range of the key holds about so many bytes of the tables that rows are computed from,
#: or so many keys if these are fewer ranges
SLICE_BYTES = 1 << 30
SLICE_KEYS = 1 << 20
MOST_SLICES = 1000


def with_month_partition(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    return df.withColumn(MONTH_PARTITION, F.date_format(F.col(date_col), "yyyy-MM"))


EMPTY_TARGET_SCHEMA = "order_date date, order_year int, order_month int"


def read_target(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The stored target in its current version; None when no write of it ever
    finished; an empty DataFrame when it holds no data files."""
    if not versions.committed(spark, path):
        return None
    try:
        return versions.read_table(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], schema or EMPTY_TARGET_SCHEMA)


def high_water_mark(target: DataFrame, col: str = "order_date", latest_month: str | None = None):
    """max(col) of the target as a Python value (a one-row aggregate).

    With ``latest_month`` (the newest ``order_month`` partition, known from
    the folder listing) only that partition is read."""
    if latest_month is not None and MONTH_PARTITION in target.columns:
        mark = target.where(F.col(MONTH_PARTITION) == F.lit(latest_month)).agg(F.max(col)).first()[0]
        if mark is not None:
            return mark
    return target.agg(F.max(col)).first()[0]


def high_water_batch(
    source: DataFrame,
    target: DataFrame | None,
    col: str = "order_date",
    lookback_days: int = 0,
    latest_month: str | None = None,
) -> DataFrame:
    """Rows of ``source`` newer than the target's maximum ``col``; all rows
    when there is no target. The mark is a literal, so the filter reaches the
    source scan (and prunes partitions when the source is partitioned)."""
    if target is None:
        return source
    mark = high_water_mark(target, col, latest_month)
    if mark is None:
        log.warning("target exists but is empty: nothing is loaded (strict high-water mark)")
        return source.where(F.lit(False))
    bound: Column = F.lit(mark)
    if lookback_days:
        bound = F.date_sub(bound, lookback_days)
    return source.where(F.col(col) > bound)


def lookback_cutoff(target: DataFrame, months: int = 1, latest: tuple | None = None):
    """First day of (latest year-month in the target) minus ``months``.
    ``latest``: the newest (order_year, order_month) partition, when known
    from the folder listing, so only that partition is read."""
    if latest is not None:
        target = target.where((F.col("order_year") == latest[0]) & (F.col("order_month") == latest[1]))
    ym = target.agg(F.max(F.col("order_year") * 100 + F.col("order_month")).alias("ym"))
    row = ym.select(
        F.add_months(F.to_date(F.col("ym").cast("string"), "yyyyMM"), -months).alias("cutoff")
    ).first()
    return row[0]


def month_lookback_batch(
    items: DataFrame,
    target: DataFrame | None,
    months: int = 1,
    date_col: str = "order_date",
    latest: tuple | None = None,
) -> DataFrame:
    """Items on or after the look-back cutoff; all items without a target.

    When the items are a stored month-partitioned fact, the cutoff is also
    applied to the partition column, so only the recent partitions are read."""
    if target is None:
        return items
    cutoff = lookback_cutoff(target, months, latest)
    if cutoff is None and latest is not None:
        cutoff = lookback_cutoff(target, months)
    if cutoff is None:
        log.warning("target exists but is empty: nothing is loaded")
        return items.where(F.lit(False))
    cond = F.col(date_col) >= F.lit(cutoff)
    if MONTH_PARTITION in items.columns:
        cond = cond & (F.col(MONTH_PARTITION) >= F.lit(cutoff.strftime("%Y-%m")))
    return items.where(cond)


def _partition_dir(partition_cols: Sequence[str], vals: tuple) -> str:
    # months need no escaping
    return "/".join(f"{c}={versions.NULL_PARTITION if v is None else v}" for c, v in zip(partition_cols, vals))


def _partition_values(folder: str) -> tuple:
    found = (x.split("=", 1)[1] for x in folder.split("/"))
    return tuple(None if v == versions.NULL_PARTITION else int(v) if v.lstrip("-").isdigit() else v for v in found)


def _write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str]) -> None:
    # REBALANCE: one shuffle by the partition columns; AQE splits large
    # partitions and merges small ones to the advisory size, so each month
    # gets a few right-sized files instead of one file per task and month.
    # Sorted files let a batch's key range skip row groups.
    rows = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
    rows.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def key_slices(rows: DataFrame, key: str, keys: DataFrame | None) -> list[Column]:
    """Conditions on ``key``, of which each row meets exactly one, that cut ``rows`` into ranges of
    bounded size. The bounds are quantiles of the values in ``keys``; how well these match the rows
    decides on the size of the ranges, not on their being complete: the first and the last are open,
    and NULLs are in the first. Rows from small tables, or whose key is not an integer, are one range."""
    if keys is None or not isinstance(keys.schema[key].dataType, IntegralType):
        return [F.lit(True)]
    most = min(leaf_bytes(rows) // SLICE_BYTES + 1, MOST_SLICES)
    if most == 1:
        return [F.lit(True)]
    quantiles = F.percentile_approx(key, [i / most for i in range(1, most)])
    found, bounds = keys.agg(F.count(key), quantiles).first()
    n = min(most, found // SLICE_KEYS + 1)
    bounds = sorted({bounds[i * most // n - 1] for i in range(1, n)})
    at = F.col(key)
    if not bounds:
        return [F.lit(True)]
    inner = [(at >= F.lit(lo)) & (at < F.lit(hi)) for lo, hi in zip(bounds, bounds[1:])]
    return [at.isNull() | (at < F.lit(bounds[0])), *inner, at >= F.lit(bounds[-1])]


def delete_insert(
    spark: SparkSession,
    batch: DataFrame,
    target_path: str,
    unique_key: Sequence[str],
    partition_by: Sequence[str],
    keys_may_move: bool = True,
    locate_by: Sequence[str] | None = None,
    full_refresh: bool = False,
    batch_keys: DataFrame | None = None,
) -> dict:
    """Replace target rows whose key occurs in ``batch`` and append the batch.

    ``keys_may_move=False`` (all partition columns are part of the key, as for
    the monthly aggregates) skips the scan for keys stored in other
    partitions. ``locate_by``: a coarser key implied by the unique key (e.g.
    order_key for a key hashed from order_key and line number) used only to
    find those partitions, so the scan reads a compact column; the batch's
    range of its first column is pushed into that scan, whose files are sorted
    by it. Partition columns must have few values, such as months: the touched
    ones are listed on the driver. With ``full_refresh`` the batch becomes the whole
    table. ``batch_keys``: a relation cheaper than the batch that holds its values of the first column of
    ``locate_by``; with it a batch computed from large tables is computed and written in ranges of that
    column. Returns a small summary dict."""
    with shuffles_cleared(spark):
        return _delete_insert(
            spark, batch, target_path, unique_key, partition_by, keys_may_move, locate_by, full_refresh, batch_keys
        )


def _delete_insert(
    spark, batch, target_path, unique_key, partition_by, keys_may_move, locate_by, full_refresh, batch_keys
) -> dict:
    unique_key, partition_by = list(unique_key), list(partition_by)
    locate = list(locate_by or unique_key)
    base = target_path.rstrip("/")
    table = versions.current(spark, base) if full_refresh else versions.adopt(spark, base)
    load = versions.new_load()
    folder = versions.load_path(base, load)
    done = False
    try:
        for part in key_slices(batch, locate[0], batch_keys):
            _write_partitioned(batch.where(part), folder, partition_by, locate)
        own = versions.partition_folders(spark, folder, len(partition_by))
        schema = versions.stored_schema(batch, partition_by)
        if table is None or full_refresh:
            made = versions.Version(0, schema, tuple(partition_by), {p: (load,) for p in own}, {load: len(own)})
            versions.commit(spark, base, made, table)
            done = True
            versions.clear_plain(spark, base)
            return {"mode": "create", "touched_partitions": None}
        if not own:
            return {"mode": "noop", "touched_partitions": []}
        # as written: the batch is not computed again
        written = versions.Version(0, schema, tuple(partition_by), {p: (load,) for p in own}, {load: len(own)})
        staged = versions.read_version(spark, base, written)
        touched = set(own)
        others = [p for p in table.parts if p not in touched]
        if keys_may_move and others:
            lo, hi = staged.agg(F.min(locate[0]), F.max(locate[0])).first()
            if lo is not None:
                far = versions.read_version(spark, base, table, others).where(F.col(locate[0]).between(F.lit(lo), F.lit(hi)))
                moved = far.join(staged.select(*locate), locate, "left_semi").select(*partition_by).distinct()
                touched |= {_partition_dir(partition_by, tuple(r)) for r in moved.collect()}
        # NULL key parts never match: such target rows stay
        target = versions.read_version(spark, base, table, touched).select(*schema.names)
        if any(p in table.parts for p in touched):
            for part in key_slices(target, locate[0], target):
                kept = target.where(part).join(staged.where(part).select(*unique_key), unique_key, "left_anti")
                _write_partitioned(kept.select(*schema.names), folder, partition_by, locate)
        present = versions.partition_folders(spark, folder, len(partition_by))
        emptied = sorted(touched - set(present))
        parts = {p: x for p, x in table.parts.items() if p not in touched} | {p: (load,) for p in present}
        made = versions.Version(0, schema, tuple(partition_by), parts, table.sizes | {load: len(present)}, table.notes)
        versions.commit(spark, base, made, table)
        done = True
        return {
            "mode": "delete+insert",
            "touched_partitions": sorted(str(_partition_values(p)) for p in touched),
            "emptied": [_partition_values(p) for p in emptied],
        }
    finally:
        if not done:
            versions.drop_load(spark, base, load)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """A stored month-partitioned fact without its partition column."""
    return versions.read_table(spark, path).drop(MONTH_PARTITION)


__all__ = [
    "delete_insert",
    "high_water_batch",
    "list_partition_dirs",
    "lookback_cutoff",
    "month_lookback_batch",
    "read_fact",
    "read_target",
    "with_month_partition",
]
