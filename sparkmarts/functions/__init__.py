"""Column helpers and join helpers used across the operators."""

from sparkmarts.functions.columns import (
    cents_to_dollars,
    day_of_week_sun0,
    month_start,
    ratio,
    surrogate_key,
    to_money,
    to_rate,
)
from sparkmarts.functions.joins import broadcast_reference, leaf_bytes

__all__ = [
    "broadcast_reference",
    "cents_to_dollars",
    "day_of_week_sun0",
    "leaf_bytes",
    "month_start",
    "ratio",
    "surrogate_key",
    "to_money",
    "to_rate",
]
