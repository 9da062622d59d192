"""Column-level helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmarts.settings import MONEY, RATE

# Marker substituted for NULL parts of a surrogate key, so that (NULL, 1) and
# ('', 1) hash differently.
SURROGATE_NULL_MARKER = "_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: str | Column) -> Column:
    return _col(c).cast(MONEY)


def to_rate(c: str | Column) -> Column:
    return _col(c).cast(RATE)


def month_start(c: str | Column) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(_col(c).cast("date"), "month")


def cents_to_dollars(c: str | Column, places: int = 2) -> Column:
    """Exact decimal division by 100, rounded to ``places`` digits."""
    return F.round(_col(c).cast("decimal(28,6)") / F.lit(100), places)


def surrogate_key(*cols: str | Column, null_marker: str = SURROGATE_NULL_MARKER) -> Column:
    """md5 over the '-'-joined string forms of the columns, NULLs replaced by a marker."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_marker)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def day_of_week_sun0(c: str | Column) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6 (Spark's dayofweek is 1-based)."""
    return F.dayofweek(_col(c)) - 1


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL when den is NULL or 0 (never raises under ANSI)."""
    n, d = _col(num), _col(den)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(
        n.cast("double") / d.cast("double")
    )
