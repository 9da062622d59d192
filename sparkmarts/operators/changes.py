"""Did a table's data change, and where? Order-insensitive fingerprints, by key
bucket if wanted, and keyed diffs that read or shuffle only the buckets that differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmarts.sources import versions

#: leaves of the fingerprint tree of two DataFrames, and key buckets of a stored table
BUCKETS, STORED_BUCKETS = 65_536, 256
BUCKET = "key_bucket"


def _text(df: DataFrame, column: str) -> Column:
    """A value as text that tells all values of its type apart."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(F.col(column))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(F.struct(F.col(column)))
    return F.col(column).cast("string")


def _row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """60 bits of the MD5 of a row's values; any engine with MD5 can compute it. Every value
    stands as its length and text, a NULL as "-", so no two rows read alike. A column that
    ``df`` lacks counts as NULL."""
    parts = []
    for c in columns or df.columns:
        if c in df.columns:
            text = _text(df, c)
            parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
        else:
            parts.append(F.lit("-"))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def _combined(h: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.bit_xor(h).alias("hash_xor"),
        F.sum(h.cast("decimal(28,0)")).cast("string").alias("hash_sum"),
    ]


def table_fingerprint(df: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row count, XOR and exact SUM of a hash of every row, for the whole table
    or per ``group_by`` (e.g. per partition column).

    Both combiners are order-insensitive and aggregate partially, so the
    fingerprint is one pass with no shuffle of rows. XOR alone would cancel a
    row present twice; the exact sum does not."""
    aggs = _combined(_row_hash(df))
    return df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)


def key_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its keys, the same whatever their numeric types."""
    return F.pmod(F.xxhash64(*(_text(df, k) for k in keys)), F.lit(buckets)).cast("int")


def bucket_fingerprints(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """Fingerprint of every key bucket over ``columns``: at most ``buckets`` rows."""
    return df.groupBy(key_bucket(df, keys, buckets).alias(BUCKET)).agg(*_combined(_row_hash(df, columns)))


def unequal_buckets(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """Buckets whose fingerprints differ: one pass over each side, no shuffle of rows."""
    b = bucket_fingerprints(before, keys, columns, buckets).select(BUCKET, F.struct("row_count", "hash_xor", "hash_sum").alias("_b"))
    a = bucket_fingerprints(after, keys, columns, buckets).select(BUCKET, F.struct("row_count", "hash_xor", "hash_sum").alias("_a"))
    return b.join(a, BUCKET, "full_outer").where(~F.col("_b").eqNullSafe(F.col("_a"))).select(BUCKET)


def table_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys added, removed or changed between two versions of a keyed table.

    Fingerprints by key bucket say which buckets differ; only their rows are
    shuffled and compared. A column that one side lacks counts as NULL there. Keys are
    expected to be unique on each side; NULL keys match nothing, so each is added or removed."""
    keys = list(keys)
    columns = sorted({*before.columns, *after.columns})
    # at most ``buckets`` numbers
    own = next(x for x in (f"{'_' * i}{BUCKET}" for i in range(len(columns) + 1)) if x not in columns)
    differ = F.broadcast(unequal_buckets(before, after, keys, columns, buckets).withColumnRenamed(BUCKET, own))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()

    def cut(df: DataFrame) -> DataFrame:
        near = df.withColumn(own, key_bucket(df, keys, buckets)).join(differ, own, "left_semi").select(*df.columns)
        nulls = df.where(null_key)  # differ from each other, wherever they stand
        return near.where(~null_key).unionByName(nulls)

    return _diff_rows(cut(before), cut(after), keys)


def _diff_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The diff by a full outer join on the keys with a NULL-safe comparison of every other column."""
    common = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c not in keys]
    side = lambda df, tag: [(F.col(c) if c in df.columns else F.lit(None)).alias(f"_{tag}_{c}") for c in common]
    b = before.select(*keys, *side(before, "b"), F.lit(True).alias("_in_b"))
    a = after.select(*keys, *side(after, "a"), F.lit(True).alias("_in_a"))
    j = b.join(a, keys, "full_outer")
    changed = F.lit(False)
    for c in common:
        changed = changed | ~F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}"))
    kind = (
        F.when(F.col("_in_b").isNull(), F.lit("added"))
        .when(F.col("_in_a").isNull(), F.lit("removed"))
        .when(changed, F.lit("changed"))
    )
    return j.select(*keys, kind.alias("change_type")).where(F.col("change_type").isNotNull())


# -- stored tables with a fingerprint per bucket --------------------------------------


def save_hashed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = STORED_BUCKETS) -> versions.Version:
    """Store ``df`` as the next version of the table at ``path``, dealt to key buckets, with every
    bucket's fingerprint in the version's notes (one small entry a bucket)."""
    keys = list(keys)
    spark = df.sparkSession
    rows = df.withColumn(BUCKET, key_bucket(df, keys, buckets))
    parent = versions.current(spark, path)
    load = versions.write_load(rows.hint("rebalance", BUCKET), path, [BUCKET])
    own = versions.partition_folders(spark, versions.load_path(path, load), 1)
    schema = versions.stored_schema(rows, [BUCKET])
    made = versions.Version(0, schema, (BUCKET,), {p: (load,) for p in own}, {load: len(own)})
    stored = versions.read_version(spark, path, made)
    prints = stored.groupBy(BUCKET).agg(*_combined(_row_hash(df, sorted(df.columns)))).collect()  # at most ``buckets`` rows
    notes = {
        "keys": keys, "buckets": buckets, "columns": sorted(df.columns),
        "fingerprints": {str(r[BUCKET]): [r["row_count"], r["hash_xor"], r["hash_sum"]] for r in prints},
    }
    made = versions.Version(0, schema, (BUCKET,), made.parts, made.sizes, notes)
    return versions.commit(spark, path, made, parent)


def stored_diff(spark: SparkSession, path: str, before: int, after: int) -> DataFrame:
    """:func:`table_diff` of two versions that :func:`save_hashed` stored: only the files of
    buckets whose fingerprints differ are read."""
    old, new = (versions.version_at(spark, path, n) for n in (before, after))
    if any(old.notes.get(x) != new.notes.get(x) for x in ("keys", "buckets")) or "fingerprints" not in new.notes:
        raise ValueError(f"{path}: versions {before} and {after} have no fingerprints to compare")
    prints = [x.notes["fingerprints"] if x.notes["columns"] == new.notes["columns"] else {} for x in (old, new)]
    every = {*old.notes["fingerprints"], *new.notes["fingerprints"]}
    differ = [f"{BUCKET}={b}" for b in sorted(every, key=int) if prints[0].get(b) != prints[1].get(b)]
    sides = [versions.read_version(spark, path, x, differ).drop(BUCKET) for x in (old, new)]
    return _diff_rows(*sides, new.notes["keys"])
