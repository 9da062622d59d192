"""Writes: full-replace tables and stored check failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sparkmarts.sources.versions import replace_table


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Materialize ``df`` as the whole contents of the table at ``path``. Readers
    (``versions.read_table``) see the old contents until the new ones are whole; a
    full replace also drops partitions that the new data lacks."""
    replace_table(df, path, partition_by)


def store_failures(failures: DataFrame, path: str) -> None:
    """Keep the failing rows of one check (replaced on every run)."""
    failures.write.mode("overwrite").parquet(path)
