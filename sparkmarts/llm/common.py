"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmarts.session import scratch_path, shuffles_cleared  # noqa: F401 (used by other modules)
from sparkmarts.sources.readers import delete_path

# A-Z to a-z; every byte that ends a word of ``WORDS`` to a space. Bytes from
# 0x80 up belong to non-ASCII characters, which are word characters.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in _LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, instead_of: DataFrame | None = None, parts: str | None = None) -> DataFrame:
    """Write to a new folder under the shared work folder and read it back:
    cuts the lineage with files that survive the loss of executors. The folder of
    ``instead_of``, an earlier table that nothing else reads, is then deleted. The rows of each
    value of the column ``parts`` lie apart, so that :func:`discard` can delete them alone."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(parts) if parts else df.write).parquet(path)
    if instead_of is not None:
        discard(instead_of)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(table: DataFrame, part: str = "") -> None:
    """Delete a materialised table, or its rows of one part (``column=value``), that nothing reads any more."""
    delete_path(table.sparkSession, f"{table.scratch}/{part}".rstrip("/"))


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name`` after as many underscores as set it apart from all ``taken`` (whatever their case)."""
    used = {x.lower() for x in taken}
    name = f"__{name}"
    while name.lower() in used:
        name = f"_{name}"
    return name


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null becomes empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterable[pa.RecordBatch], name: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices whose column ``name`` holds about ``max_bytes``
    at most (one row may hold more), so that a worker's memory stays bounded."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column_of(batch, name)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def map_slices(
    df: DataFrame,
    text_col: str,
    fn: Callable[[pa.RecordBatch], dict],
    added: str,
    keep: list[str] | None = None,
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """One output row per input row: the columns ``keep`` (all by default)
    and those of the DDL string ``added``, whose values ``fn`` returns for a
    bounded slice of rows as {name: list or Arrow array}. ``fn`` finds the text
    as ``__text``; a kept column of that name has another one inside. A column of
    ``df`` with the name of an added one (in any case) gives way to it."""
    more = T.StructType.fromDDL(added)
    taken = {f.name.lower() for f in more.fields}
    names = [c for c in (keep if keep is not None else df.columns) if c.lower() not in taken]
    own = lambda c: fresh("text", [*names, "__text"]) if c.lower() == "__text" else c
    inside = df.select(*(F.col(f"`{c}`").alias(own(c)) for c in names), F.col(f"`{text_col}`").alias("__text"))
    kept = [T.StructField(c, f.dataType, f.nullable, f.metadata) for c, f in zip(names, inside.schema.fields, strict=False)]
    schema = T.StructType(kept + more.fields)
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in more.fields}

    def run(batches):
        for part in slices(batches, "__text", slice_bytes):
            got = fn(part)
            arrays = part.columns[:-1] + [
                v if isinstance(v, pa.Array) else pa.array(v, kinds[k]) for k, v in ((k, got[k]) for k in kinds)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *kinds])

    return inside.mapInArrow(run, schema)
