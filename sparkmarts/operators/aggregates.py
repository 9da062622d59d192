"""Monthly revenue aggregates by customer nation and by sales region.

Both shapes avoid a ``count(distinct order_key)`` next to the sums: rows are
first collapsed per (group, year, month, order_key) and then per
(group, year, month), so the distinct count becomes a plain count and both
levels aggregate partially before their shuffle. Averages are carried as
sum and count and divided once at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.functions.columns import ratio

MEASURES = [
    "order_count", "total_quantity", "gross_revenue", "net_revenue",
    "net_revenue_after_tax", "avg_discount_rate",
]


def _finish(per_order: DataFrame, group_col: str, out_name: str) -> DataFrame:
    agg = per_order.groupBy(group_col, "order_year", "order_month").agg(
        F.count("order_key").alias("order_count"),  # a NULL key is no order
        F.sum("q").alias("total_quantity"),
        F.sum("g").alias("gross_revenue"),
        F.sum("n").alias("net_revenue"),
        F.sum("t").alias("net_revenue_after_tax"),
        F.sum("ds").alias("_ds"),
        F.sum("dc").alias("_dc"),
    )
    return agg.select(
        F.col(group_col).alias(out_name),
        "order_year",
        "order_month",
        "order_count",
        "total_quantity",
        "gross_revenue",
        "net_revenue",
        "net_revenue_after_tax",
        ratio("_ds", "_dc").alias("avg_discount_rate"),
    )


def revenue_by(order_items: DataFrame, group_col: str, out_name: str | None = None) -> DataFrame:
    """Monthly revenue from a line-level fact (``fct_order_items`` shape):
    order_key, order_date, ``group_col``, quantity, extended_price,
    discounted_price, net_price, discount_percentage."""
    out_name = out_name or group_col
    keyed = order_items.select(
        group_col,
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        "order_key",
        "quantity",
        "extended_price",
        "discounted_price",
        "net_price",
        "discount_percentage",
    )
    per_order = keyed.groupBy(group_col, "order_year", "order_month", "order_key").agg(
        F.sum("quantity").alias("q"),
        F.sum("extended_price").alias("g"),
        F.sum("discounted_price").alias("n"),
        F.sum("net_price").alias("t"),
        F.sum("discount_percentage").alias("ds"),
        F.count("discount_percentage").alias("dc"),
    )
    return _finish(per_order, group_col, out_name)


def revenue_by_from_rollup(
    rollup: DataFrame, orders_enriched: DataFrame, group_col: str, out_name: str | None = None
) -> DataFrame:
    """Same result as :func:`revenue_by` over the line-level fact, computed
    from the per-order rollup (:func:`order_line_rollup`) joined to the
    enriched orders: line items are aggregated per order *before* the join,
    so the join and the group-by see one row per order instead of per line."""
    out_name = out_name or group_col
    ctx = orders_enriched.select(
        "order_key",
        group_col,
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
    )
    joined = rollup.join(ctx, "order_key", "inner")
    # The join output is hash-partitioned by order_key, which already clusters
    # (group, year, month, order_key): this level needs no extra shuffle.
    per_order = joined.groupBy(group_col, "order_year", "order_month", "order_key").agg(
        F.sum("total_quantity").alias("q"),
        F.sum("gross_revenue").alias("g"),
        F.sum("net_revenue").alias("n"),
        F.sum("net_revenue_after_tax").alias("t"),
        F.sum("discount_sum").alias("ds"),
        F.sum("discount_count").alias("dc"),
    )
    return _finish(per_order, group_col, out_name)


def revenue_by_nation(order_items: DataFrame) -> DataFrame:
    return revenue_by(order_items, "customer_nation", "nation_name")


def revenue_by_sales_region(order_items: DataFrame) -> DataFrame:
    return revenue_by(order_items, "sales_region", "sales_region")
