"""Broadcast of small reference tables, and tasks of bounded size, decided from plan statistics.

Only nations, regions and seeds, and suppliers up to 16 MB, are hinted, and only while the
tables they are read from are proven small: the statistics of the plan's leaves (file sizes,
inline rows) are summed without starting a job. Customers, parts and key sets grow with the data and are never hinted; the planner and AQE choose,
and split skewed partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.settings import DEFAULT_SETTINGS


def leaf_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` is computed from, as the planner knows
    them; a source without statistics counts as huge."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_reference(df: DataFrame, max_bytes: int | None = None, times: int = 1) -> DataFrame:
    """``F.broadcast(df)`` while its source tables hold ``max_bytes`` (by default ``times`` the
    setting) at most, else ``df``."""
    bound = times * DEFAULT_SETTINGS.reference_max_bytes if max_bytes is None else max_bytes
    return F.broadcast(df) if leaf_bytes(df) <= bound else df


#: bytes of the source tables for each task of :func:`dealt`
TASK_BYTES = 8 << 20
MOST_TASKS = 20_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to tasks whose number follows the size of the tables that
    ``df`` is computed from, for groupings that hold about a group for every row: the
    session's number of partitions, which does not follow the data, would let a
    task's memory grow with them. Tables of unknown size are left to the planner."""
    size = leaf_bytes(df)
    if size >= 1 << 60:
        return df
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES + 1)
    return df.repartition(min(tasks, MOST_TASKS), *keys)
