"""Two-load scenarios derived from the given tables, used to exercise the
incremental and history operators end to end (the same rules are written in
the oracle SQL). They change which rows arrive when, never the row count of
what is read: every load reads the whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.settings import MONEY

# Fact loads: the first load holds orders dated before LOAD1_BEFORE except
# the late ones (low-priority orders, which arrive only with the second
# load); the second load holds all orders, with the pending urgent orders
# re-dated to MOVED_DATE (changed orders that must replace their old rows and
# leave their old months).
LOAD1_BEFORE = dt.date(2000, 1, 1)
LATE_PRIORITY = "5-LOW"
MOVED_STATUS, MOVED_PRIORITY = "P", "1-URGENT"
MOVED_DATE = dt.date(2001, 9, 1)
# Aggregate loads: the first from items dated before AGG_LOAD1_BEFORE (a
# partial month), the second from all items of the second fact load.
AGG_LOAD1_BEFORE = dt.date(2000, 1, 15)

# History loads.
SNAPSHOT_T1 = dt.datetime(2024, 1, 1, 0, 0, 0)
SNAPSHOT_T2 = dt.datetime(2024, 1, 2, 0, 0, 0)


def orders_load1(orders: DataFrame) -> DataFrame:
    return orders.where((F.col("order_date") < F.lit(LOAD1_BEFORE)) & (F.col("priority_code") != LATE_PRIORITY))


def orders_load2(orders: DataFrame) -> DataFrame:
    moved = (F.col("status_code") == MOVED_STATUS) & (F.col("priority_code") == MOVED_PRIORITY)
    return orders.withColumn("order_date", F.when(moved, F.lit(MOVED_DATE)).otherwise(F.col("order_date")))


def history_load1(entities: DataFrame) -> DataFrame:
    """First load: every entity except overdrawn accounts (balance < 0),
    which arrive with the second load."""
    return entities.where(~(F.col("account_balance") < 0))


def history_load2(entities: DataFrame) -> DataFrame:
    """Second load, by balance band of the first: >= 9000 revalued by +100,
    [0, 500) balance unknown (NULL), [500, 1000) new phone number (not a
    checked column), [1000, 1500) closed (absent); overdrawn accounts new."""
    b = F.col("account_balance")
    return (
        entities.where(~((b >= 1000) & (b < 1500)))
        .withColumn(
            "phone_number", F.when((b >= 500) & (b < 1000), F.lit("changed")).otherwise(F.col("phone_number"))
        )
        .withColumn(
            "account_balance",
            F.when(b >= 9000, (b + 100).cast(MONEY)).when((b >= 0) & (b < 500), F.lit(None).cast(MONEY)).otherwise(b),
        )
    )


# Planted violations for checks that pass on clean data.
def planted_null_names(customers: DataFrame) -> DataFrame:
    """Overdrawn accounts lose their name."""
    return customers.withColumn(
        "customer_name", F.when(F.col("account_balance") < 0, F.lit(None)).otherwise(F.col("customer_name"))
    )


def planted_status(orders: DataFrame) -> DataFrame:
    """Pending orders of unspecified priority get an unknown status 'X'."""
    bad = (F.col("status_code") == "P") & (F.col("priority_code") == "4-NOT SPECIFIED")
    return orders.withColumn("status_code", F.when(bad, F.lit("X")).otherwise(F.col("status_code")))


def planted_negative_discount(line_items: DataFrame) -> DataFrame:
    """Lines of the largest quantity (50) get a negative discount."""
    from sparkmarts.settings import RATE

    return line_items.withColumn(
        "discount_percentage",
        F.when(F.col("quantity") == 50, F.lit(-0.05).cast(RATE)).otherwise(F.col("discount_percentage")),
    )


FRESHNESS_NOW = dt.datetime(2024, 2, 3, 0, 0, 0)
APPEND_BATCH_FROM = dt.date(2001, 1, 1)
APPEND_LOADED_AT = dt.datetime(2024, 1, 1, 0, 0, 0)
