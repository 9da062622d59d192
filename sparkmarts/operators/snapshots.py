"""Type-2 history ("check" strategy) of an entity table, merged on read.

A load stores only the versions that it opens. A version is closed by the next one of its
key, so the end of its validity follows from the rows themselves: readers fold it in with a
window over the key. Storage is a versioned table (:mod:`sparkmarts.sources.versions`: readers see a load
as a whole or not at all) partitioned by ``_state``:

* ``open``: the versions that were open at the last compaction;
* ``change``: versions opened by the loads since then, one folder of files each;
* ``closed``: versions that were closed at the last compaction, with their end.

A load is one aggregation by key over the open and changed versions and the new
extract: it finds the newest version of each key, compares it, and counts NULL and repeated keys of the
extract and the newest time on the way (observed metrics of the same job). What it writes
follows the changes. Every ``compact_after`` loads the changes are folded into ``open`` and ``closed``.

Load times count to the microsecond. Re-running the same load is a no-op (nothing differs,
nothing is written); a different load with the time of an applied one is refused, and so is an
extract with NULL or repeated keys.

Rules: a version opens for a new key and for a key whose checked columns
differ (NULL-safe: NULL <-> value is a change); changes in other columns open
nothing; keys missing from the extract stay open (no hard deletes)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sparkmarts.sources import versions

STATE = "_state"
OPEN, CHANGE, CLOSED = "open", "change", "closed"
#: loads after which the changes are folded into the open and closed versions
COMPACT_AFTER = 16
VALIDITY_COLUMNS = ["scd_id", "valid_from", "valid_to", "updated_at"]

CUSTOMER_SNAPSHOT = {
    "key": "customer_key",
    "columns": ["customer_key", "customer_name", "customer_address", "nation_key", "phone_number",
                "account_balance", "market_segment"],
    "check": ["account_balance", "market_segment", "customer_address"],
}
SUPPLIER_SNAPSHOT = {
    "key": "supplier_key",
    "columns": ["supplier_key", "supplier_name", "supplier_address", "nation_key", "phone_number",
                "account_balance"],
    "check": ["account_balance", "supplier_address"],
}


def scd_id(key: str, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), valid_from.cast("string")))


def _ts(t: dt.datetime) -> Column:
    return F.lit(t.isoformat(" ")).cast("timestamp_ntz")


def _utc(t: dt.datetime) -> dt.datetime:
    return t if t.tzinfo is None else t.astimezone(dt.timezone.utc).replace(tzinfo=None)


class BadKeys(ValueError):
    pass


def _open_versions(df: DataFrame, key: str, columns: Sequence[str], load_ts: dt.datetime, state: str) -> DataFrame:
    t = _ts(load_ts)
    return df.select(
        *columns,
        scd_id(key, t).alias("scd_id"),
        t.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        t.alias("updated_at"),
        F.lit(state).alias(STATE),
    )


def _folder(state: str) -> str:
    return f"{STATE}={state}"


def _part(spark: SparkSession, base: str, version: versions.Version, *states: str) -> DataFrame:
    return versions.read_version(spark, base, version, [_folder(x) for x in states])


def _by_key(new: DataFrame, stored: DataFrame | None, key: str, check_cols: Sequence[str]) -> DataFrame:
    """For each key the time and checked columns of its newest stored version, the
    arrived row, and how many arrived: all meet in one shuffle."""
    kind = new.schema.simpleString()
    arrived = new.select(F.col(key).alias("_key"), F.lit(None).cast("timestamp_ntz").alias("_from"), F.struct("*").alias("_new"))
    if stored is None:
        rows = arrived.withColumn("_old", F.lit(None).cast("string"))
    else:
        old = F.struct(*(F.col(c) for c in check_cols))
        rows = stored.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.lit(None).cast(kind).alias("_new"), old.alias("_old"))
        rows = rows.unionByName(arrived.withColumn("_old", F.lit(None).cast(rows.schema["_old"].dataType)))
    return rows.groupBy("_key").agg(
        F.max("_from").alias("_latest"),
        F.max_by("_old", "_from").alias("_old"),
        F.first("_new", ignorenulls=True).alias("_new"),
        F.count("_new").alias("_arrived"),
    )


def snapshot_check(
    spark: SparkSession,
    extract: DataFrame,
    snapshot_path: str,
    key: str,
    check_cols: Sequence[str],
    load_ts: dt.datetime,
    columns: Sequence[str] | None = None,
    compact_after: int = COMPACT_AFTER,
) -> dict:
    """Apply one extract of the entity table to its history at ``snapshot_path``."""
    columns = list(columns or extract.columns)
    load_ts = _utc(load_ts)
    base = snapshot_path.rstrip("/")
    parent = _adopted(spark, base)
    state = CHANGE if parent else OPEN
    found = _by_key(extract.select(*columns), _part(spark, base, parent, OPEN, CHANGE) if parent else None, key, check_cols)
    seen = Observation()
    bad = (F.col("_arrived") > 1) | (F.col("_key").isNull() & (F.col("_arrived") > 0))
    found = found.observe(
        seen, F.count_if(bad).alias("bad"), F.max(F.when(bad, F.col("_key").cast("string"))).alias("key"), F.max("_latest").alias("latest")
    )
    opens = F.col("_latest").isNull()
    if parent:
        for col in check_cols:
            opens = opens | ~F.col(f"_old.{col}").eqNullSafe(F.col(f"_new.{col}"))
    out = _open_versions(found.where((F.col("_arrived") > 0) & opens).select("_new.*"), key, columns, load_ts, state)
    load = versions.write_load(out, base, [STATE])
    done = False
    try:
        got = seen.get
        if got["bad"]:
            raise BadKeys(f"the extract has a NULL or repeated {key}: {got['key']}")
        latest = got["latest"]
        if latest is not None and load_ts < latest:
            raise ValueError(f"load time {load_ts} is earlier than the latest version ({latest})")
        own = versions.partition_folders(spark, versions.load_path(base, load), 1)
        if parent is not None and not own:
            return {"mode": "noop"}
        if latest is not None and latest == load_ts:
            raise ValueError(f"a different load with time {load_ts} was already applied")
        parts, sizes = (dict(parent.parts), parent.sizes) if parent else ({}, {})
        if own:
            parts[_folder(state)] = (*parts.get(_folder(state), ()), load)
        made = versions.Version(0, versions.stored_schema(out, [STATE]), (STATE,), parts, sizes | {load: len(own)}, {"key": key})
        made = versions.commit(spark, base, made, parent)
        done = True
    finally:
        if not done:
            versions.drop_load(spark, base, load)
    if len(made.parts.get(_folder(CHANGE), ())) >= compact_after:
        compact(spark, base)
    return {"mode": "update" if parent else "create"}


def _adopted(spark: SparkSession, base: str) -> versions.Version | None:
    """The current version; a history that an older release stored without versions is taken over."""
    version = versions.current(spark, base)
    if version is None and versions.committed(spark, base):
        plain = spark.read.parquet(base)
        state = F.when(F.col(STATE) == "current", OPEN).otherwise(CLOSED)
        version = versions.replace_table(plain.withColumn(STATE, state), base, [STATE], {"key": plain.columns[0]})
    return version


def _folded(rows: DataFrame, key: str) -> DataFrame:
    """Versions with their end: where the key's next one begins."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return rows.withColumn("valid_to", F.coalesce("valid_to", following))


def compact(spark: SparkSession, snapshot_path: str) -> bool:
    """Fold the changes into the open and closed versions. Contents stay the same.
    True if there was anything to do."""
    base = snapshot_path.rstrip("/")
    parent = versions.current(spark, base)
    if parent is None or _folder(CHANGE) not in parent.parts:
        return False
    folded = _folded(_part(spark, base, parent, OPEN, CHANGE), parent.notes["key"])
    state = F.when(F.col("valid_to").isNull(), OPEN).otherwise(CLOSED)
    load = versions.write_load(folded.withColumn(STATE, state), base, [STATE])
    own = versions.partition_folders(spark, versions.load_path(base, load), 1)
    parts = {p: (load,) for p in own}
    earlier = parent.parts.get(_folder(CLOSED), ())
    if earlier:
        parts[_folder(CLOSED)] = (*earlier, *parts.get(_folder(CLOSED), ()))
    made = versions.Version(0, parent.schema, (STATE,), parts, parent.sizes | {load: len(own)}, parent.notes)
    try:
        versions.commit(spark, base, made, parent)
    except versions.LostRace:
        # another load came first; a later one compacts
        versions.drop_load(spark, base, load)
        return False
    return True


def read_snapshot(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """All versions (open and closed) with the end of their validity, without the
    storage partition column."""
    version = _adopted(spark, snapshot_path.rstrip("/"))
    if version is None:
        return spark.read.parquet(snapshot_path)  # fails with Spark's own error
    if _folder(CHANGE) not in version.parts:
        return versions.read_version(spark, snapshot_path, version).drop(STATE)
    folded = _folded(_part(spark, snapshot_path, version, OPEN, CHANGE), version.notes["key"])
    return folded.unionByName(_part(spark, snapshot_path, version, CLOSED)).drop(STATE)


def snapshot_customers(spark: SparkSession, customers: DataFrame, snapshot_path: str, load_ts: dt.datetime) -> dict:
    s = CUSTOMER_SNAPSHOT
    return snapshot_check(spark, customers, snapshot_path, s["key"], s["check"], load_ts, s["columns"])


def snapshot_suppliers(spark: SparkSession, suppliers: DataFrame, snapshot_path: str, load_ts: dt.datetime) -> dict:
    s = SUPPLIER_SNAPSHOT
    return snapshot_check(spark, suppliers, snapshot_path, s["key"], s["check"], load_ts, s["columns"])
