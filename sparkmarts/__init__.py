"""sparkmarts: an order-analytics warehouse built as plain Spark DataFrame operators.

Raw TPC-H style tables are staged (renamed and typed), enriched by joins, and
turned into facts, dimensions, incremental monthly aggregates, type-2 history,
data-quality checks and reports. Every operator is a function over DataFrames
(or over stored tables for the incremental and history operators), so all the
work is planned by Catalyst and runs on the cluster.
"""

from sparkmarts.settings import Settings, DEFAULT_SETTINGS

__all__ = ["Settings", "DEFAULT_SETTINGS"]
