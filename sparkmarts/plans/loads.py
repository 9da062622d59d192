"""Incremental loads of the facts and the monthly aggregates into stored
month-partitioned Parquet targets (first run = full build)."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmarts.operators import aggregates, facts
from sparkmarts.operators.incremental import (
    MONTH_PARTITION,
    delete_insert,
    high_water_batch,
    month_lookback_batch,
    read_target,
    with_month_partition,
)
from sparkmarts.sources.readers import latest_partition

log = logging.getLogger(__name__)
Enrich = Callable[[DataFrame], DataFrame]


def _latest_month(spark: SparkSession, target_path: str) -> str | None:
    """Newest order_month partition of a stored fact (folder listing only)."""
    latest = latest_partition(spark, target_path, [MONTH_PARTITION])
    return latest[0] if latest else None


def new_orders(
    spark: SparkSession, orders: DataFrame, target_path: str, lookback_days: int = 0, full_refresh: bool = False
) -> tuple[DataFrame, bool]:
    """Orders past the stored fact's high-water mark, and whether there is a
    stored fact that stays; all orders with ``full_refresh``. Only columns of ``orders`` itself are read, so the mark cuts
    the rows before any enrichment."""
    target = None if full_refresh else read_target(spark, target_path)
    rows = high_water_batch(orders, target, "order_date", lookback_days, _latest_month(spark, target_path))
    return rows, target is not None


def late_orders(orders: DataFrame, stored: DataFrame) -> DataFrame:
    """Orders that the strict mark passes over: dated up to the stored maximum,
    but not stored. For reports after a load; ``lookback_days`` loads them."""
    mark = stored.agg(F.max("order_date")).scalar()
    return orders.where(F.col("order_date") <= mark).join(stored.select("order_key"), "order_key", "left_anti")


def _lines_of(line_items: DataFrame, orders: DataFrame, incremental: bool) -> DataFrame:
    """Lines of the given orders, cut before anything is joined to them."""
    return line_items.join(orders.select("order_key"), "order_key", "left_semi") if incremental else line_items


def store_fct_orders(spark: SparkSession, orders_enriched: DataFrame, line_items: DataFrame, target_path: str, some: bool, full_refresh: bool = False) -> dict:
    batch = facts.fct_orders(orders_enriched, line_items, restrict_to_orders=some)
    return delete_insert(
        spark, with_month_partition(batch), target_path, ["order_key"], [MONTH_PARTITION], full_refresh=full_refresh
    )


def _store_lines(spark, fact, orders_enriched, line_items, target_path, some, enrich, full_refresh=False, orders=None) -> dict:
    if enrich:
        # the orders cut the lines, and are not joined again, before parts and suppliers widen them
        lines = enrich(facts.lines_with_orders(line_items, orders_enriched))
    else:
        lines = _lines_of(line_items, orders_enriched, some)
    batch = fact(lines, orders_enriched)
    return delete_insert(
        spark, with_month_partition(batch), target_path, ["order_item_key"], [MONTH_PARTITION], locate_by=["order_key"],
        full_refresh=full_refresh, batch_keys=orders,
    )


def store_fct_order_items(
    spark, orders_enriched, line_items, target_path, some: bool, enrich: Enrich | None = None, full_refresh: bool = False,
    orders: DataFrame | None = None,
) -> dict:
    """``orders``: the orders before they were enriched, if the load may go through them in ranges of their key."""
    return _store_lines(
        spark, facts.fct_order_items, orders_enriched, line_items, target_path, some, enrich, full_refresh, orders
    )


def store_fct_returns(
    spark, orders_enriched, line_items, target_path, some: bool, enrich: Enrich | None = None, full_refresh: bool = False
) -> dict:
    return _store_lines(spark, facts.fct_returns, orders_enriched, line_items, target_path, some, enrich, full_refresh)


def load_fct_orders(
    spark: SparkSession, orders: DataFrame, line_items: DataFrame, target_path: str, lookback_days: int = 0,
    enrich_orders: Enrich | None = None, full_refresh: bool = False,
) -> dict:
    """Orders newer than the target's latest order date, rolled up from only
    their own line items (semi join before the aggregation), delete+insert
    by order_key. ``orders`` are enriched already, or ``enrich_orders`` does it
    after the mark has cut them."""
    rows, some = new_orders(spark, orders, target_path, lookback_days, full_refresh)
    return store_fct_orders(spark, enrich_orders(rows) if enrich_orders else rows, line_items, target_path, some, full_refresh)


def load_fct_order_items(
    spark: SparkSession, line_items: DataFrame, orders: DataFrame, target_path: str, lookback_days: int = 0,
    enrich: Enrich | None = None, enrich_orders: Enrich | None = None, full_refresh: bool = False,
) -> dict:
    """``line_items`` are enriched already, or ``enrich`` adds part and
    supplier attributes to the new orders' lines only."""
    new, some = new_orders(spark, orders, target_path, lookback_days, full_refresh)
    rows = enrich_orders(new) if enrich_orders else new
    return store_fct_order_items(spark, rows, line_items, target_path, some, enrich, full_refresh, new)


def load_fct_returns(
    spark: SparkSession, line_items: DataFrame, orders: DataFrame, target_path: str, lookback_days: int = 0,
    enrich: Enrich | None = None, enrich_orders: Enrich | None = None, full_refresh: bool = False,
) -> dict:
    """As :func:`load_fct_order_items`, for returned lines."""
    rows, some = new_orders(spark, orders, target_path, lookback_days, full_refresh)
    rows = enrich_orders(rows) if enrich_orders else rows
    return store_fct_returns(spark, rows, line_items, target_path, some, enrich, full_refresh)


def load_revenue(
    spark: SparkSession, order_items: DataFrame, target_path: str, group_col: str, out_name: str,
    lookback_months: int = 1, full_refresh: bool = False,
) -> dict:
    """Recompute the months from (latest stored month - ``lookback_months``)
    on, replace those (group, year, month) rows; older months stay."""
    target = None if full_refresh else read_target(spark, target_path)
    latest = latest_partition(spark, target_path, ["order_year", "order_month"]) if target is not None else None
    items = month_lookback_batch(order_items, target, lookback_months, latest=latest)
    batch = aggregates.revenue_by(items, group_col, out_name)
    return delete_insert(
        spark, batch, target_path, [out_name, "order_year", "order_month"], ["order_year", "order_month"],
        keys_may_move=False, full_refresh=full_refresh,
    )


def load_revenue_by_nation(
    spark: SparkSession, order_items: DataFrame, target_path: str, lookback_months: int = 1, full_refresh: bool = False
) -> dict:
    return load_revenue(spark, order_items, target_path, "customer_nation", "nation_name", lookback_months, full_refresh)


def load_revenue_by_sales_region(
    spark: SparkSession, order_items: DataFrame, target_path: str, lookback_months: int = 1, full_refresh: bool = False
) -> dict:
    return load_revenue(spark, order_items, target_path, "sales_region", "sales_region", lookback_months, full_refresh)
