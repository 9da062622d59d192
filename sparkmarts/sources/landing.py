"""Landing copies of source tables, reloads, and key allocation for
arriving batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmarts.session import scratch_path
from sparkmarts.sources import versions
from sparkmarts.sources.readers import SOURCE_TABLES, delete_path, read_source, source_path
from sparkmarts.sources.sinks import save_table
from sparkmarts.sources.versions import committed

RELOAD_METHODS = ("truncate_reload", "recreate")


def land_tables(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    tables: Sequence[str] | None = None,
    full_refresh: bool = False,
) -> list[tuple[str, str]]:
    """Copy source tables to ``dst_root``: create when absent, skip when
    present, drop and recreate with ``full_refresh``. Default: all eight
    source tables. Returns (table, action) pairs."""
    selected = list(SOURCE_TABLES if tables is None else tables)
    if not selected:
        raise ValueError("no tables selected")
    actions = []
    for t in selected:
        dst = source_path(dst_root, t)
        exists = committed(spark, dst)
        if exists and not full_refresh:
            actions.append((t, "skipped"))
            continue
        save_table(read_source(spark, src_root, t), dst)
        actions.append((t, "replaced" if exists else "created"))
    return actions


def reload_table(
    spark: SparkSession, src_root: str, dst_root: str, tables: Sequence[str], method: str = "truncate_reload"
) -> list[tuple[str, str]]:
    """Reload landed tables from the source: ``truncate_reload`` replaces the
    contents of the table and keeps its columns' types, ``recreate`` takes the source's
    schema as it is. Either way readers see the old table until the new one is whole.
    An empty list or an unknown method is an error."""
    if not tables:
        raise ValueError("reload_table needs an explicit list of tables")
    if method not in RELOAD_METHODS:
        raise ValueError(f"method must be one of {RELOAD_METHODS}, got {method!r}")
    out = []
    for t in tables:
        dst = source_path(dst_root, t)
        src = read_source(spark, src_root, t)
        stored = versions.current(spark, dst)
        if method == "truncate_reload" and stored is not None:
            src = src.select(*(F.col(c).cast(stored.schema[c].dataType) if c in stored.schema.names else F.col(c) for c in src.columns))
        save_table(src, dst)
        out.append((t, method))
    return out


def assign_next_keys(
    spark: SparkSession,
    batch: DataFrame,
    key: str,
    start_after: int,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    return _assign_next_keys(spark, batch, key, start_after, order_by)[0]


def _assign_next_keys(
    spark: SparkSession,
    batch: DataFrame,
    key: str,
    start_after: int,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, str]:
    """Gap-free keys ``start_after + 1 .. start_after + n`` for the batch rows.

    With ``order_by`` the numbering follows that order (a range-partitioned
    sort); otherwise it follows the batch's partition order. No global
    ``row_number`` window (that would run in one task): each row gets its
    (partition id, position in partition); per-partition row counts — one
    row per partition, so their size is bounded by the partition count —
    give each partition's offset. The tagged batch is written once to the
    shared work folder so both passes see the same rows."""
    if order_by:
        # the other columns break ties: equal sort keys spread over several
        # range partitions, and the numbering is the same on every retry
        rest = [c for c in batch.columns if c not in order_by]
        src = batch.orderBy(*order_by, *rest)
    else:
        src = batch
    tagged = src.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    )
    path = scratch_path(spark, "keyed-batch")
    tagged.write.mode("overwrite").parquet(path)
    tagged = spark.read.parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    # one row per partition of the batch: bounded by the partition count
    keyed = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        key, (F.lit(start_after) + F.col("_off") + F.col("_pos") + 1).cast("bigint")
    )
    cols = [key] + [c for c in batch.columns if c != key]
    return keyed.select(*cols), path


def append_with_next_keys(
    spark: SparkSession,
    target_path: str,
    batch: DataFrame,
    key: str,
    loaded_at: dt.datetime,
    order_by: Sequence[str] | None = None,
    batch_id: str | None = None,
    attempts: int = 5,
) -> dict:
    """Append ``batch`` to the table at ``target_path`` with fresh keys after
    ``coalesce(max(key), 0)`` and ``loaded_at`` set to the given time (UTC
    if it has a zone). An empty batch is an error.

    The keys are reserved by the version that adds the batch: of two writers that
    start from one version the later finds the next one taken and numbers its batch again after it. The
    version also notes ``batch_id``: a batch whose id is noted is not appended again, so a
    caller that does not know whether its append succeeded can repeat it."""
    if batch.isEmpty():
        raise ValueError("batch must contain at least one row")
    if loaded_at.tzinfo is not None:
        loaded_at = loaded_at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    ts = F.lit(loaded_at.isoformat(" ")).cast("timestamp_ntz")
    for _ in range(attempts):
        parent = versions.adopt(spark, target_path)
        batches = dict(parent.notes.get("batches", {})) if parent else {}
        if batch_id is not None and batch_id in batches:
            return {"first_key": batches[batch_id], "appended": False}
        start = _last_key(spark, target_path, parent, key)
        keyed, scratch = _assign_next_keys(spark, batch, key, start, order_by)
        try:
            rows = keyed.withColumn("loaded_at", ts)
            load = versions.write_load(rows, target_path)
            last = versions.load_path(target_path, load)
            highest = spark.read.parquet(last).agg(F.max(key)).first()[0]
        finally:
            delete_path(spark, scratch)
        if batch_id is not None:
            batches[batch_id] = start + 1
        try:
            _commit_append(spark, target_path, parent, rows, load, {"batches": batches, "last_key": {key: int(highest)}})
            return {"first_key": start + 1, "appended": True}
        except versions.LostRace:
            versions.drop_load(spark, target_path, load)
    raise versions.LostRace(f"{target_path}: other writers were faster {attempts} times")


def _last_key(spark: SparkSession, path: str, version: versions.Version | None, key: str) -> int:
    """The highest key, as the last append noted it, or from one column of the table."""
    if version is None:
        return 0
    noted = version.notes.get("last_key", {}).get(key)
    if noted is not None:
        return int(noted)
    return int(versions.read_version(spark, path, version).agg(F.coalesce(F.max(key), F.lit(0))).first()[0])


def _commit_append(spark: SparkSession, path: str, parent: versions.Version | None, rows: DataFrame, load: str, notes: dict) -> None:
    schema = versions.stored_schema(rows, ())
    if parent is None:
        versions.commit(spark, path, versions.Version(0, schema, (), {"": (load,)}, {load: 1}, notes), None)
        return
    if parent.partition_by:
        raise ValueError(f"{path} is partitioned: batches are appended to tables without partitions")
    # columns that only the batch has read as NULL in earlier rows
    for f in parent.schema.fields:
        if f.name in schema.names and schema[f.name].dataType != f.dataType:
            raise ValueError(f"{path}: {f.name} is {f.dataType.simpleString()}, in the batch {schema[f.name].dataType.simpleString()}")
    merged = T.StructType([*parent.schema.fields, *(f for f in schema.fields if f.name not in parent.schema.names)])
    parts = {"": (*parent.parts.get("", ()), load)}
    made = versions.Version(0, merged, (), parts, parent.sizes | {load: 1}, parent.notes | notes)
    versions.commit(spark, path, made, parent)
