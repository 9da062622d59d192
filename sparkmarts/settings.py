"""Project-wide settings: types, date-spine range, check thresholds, size bounds."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Money (prices, balances, quantities) and rates are exact decimals. Narrow
# rates keep products small: p * (1 - d) * (1 + t) sums to decimal(34,6).
MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"
FX_RATE = "decimal(12,6)"


@dataclass(frozen=True)
class Freshness:
    warn_after_hours: float
    error_after_hours: float


@dataclass(frozen=True)
class Settings:
    # Date dimension range, end exclusive.
    date_spine_start: dt.date = dt.date(1992, 1, 1)
    date_spine_end: dt.date = dt.date(2000, 1, 1)
    # Severity of data-quality checks when none is given.
    default_severity: str = "warn"
    # Freshness thresholds: default for tables checked by storage metadata,
    # and per-table thresholds for tables with a load-time column.
    default_freshness: Freshness = Freshness(24, 72)
    table_freshness: dict = field(
        default_factory=lambda: {
            "orders": Freshness(48, 168),
            "lineitem": Freshness(48, 168),
        }
    )
    # Load-time column and row filter of the tables that have one.
    table_loaded_at: dict = field(
        default_factory=lambda: {
            "orders": ("loaded_at", "o_orderdate >= '1990-01-01'"),
            "lineitem": ("loaded_at", None),
        }
    )
    # Most bytes the source tables of a reference relation (nation, region,
    # seeds) may have for a broadcast hint. Beyond it the join is left to the
    # planner (sort-merge with AQE skew splitting).
    reference_max_bytes: int = 1 << 20
    # Month look-back of the incremental aggregates.
    aggregate_lookback_months: int = 1


DEFAULT_SETTINGS = Settings()
