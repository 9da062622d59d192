"""Facts: orders (with a per-order line-item rollup), order items, returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.functions.columns import ratio, surrogate_key
from sparkmarts.operators.enrich import ORDER_CONTEXT_COLUMNS, priced_line_items

FCT_ORDERS_COLUMNS = [
    "order_key", "customer_key", "customer_name", "customer_nation", "customer_region",
    "sales_region", "market_segment", "order_date", "status_code", "priority_code",
    "total_price", "clerk_name", "line_item_count", "gross_revenue", "net_revenue",
    "net_revenue_after_tax", "total_quantity", "avg_discount_rate", "first_ship_date",
    "last_ship_date",
]

FCT_ORDER_ITEMS_COLUMNS = [
    "order_item_key", "order_key", "line_number", "part_key", "supplier_key",
    "order_date", "customer_key", "customer_nation", "customer_region", "sales_region",
    "order_status", "part_name", "brand", "part_type", "manufacturer", "retail_price",
    "supplier_name", "supplier_nation", "quantity", "extended_price",
    "discount_percentage", "tax_rate", "discounted_price", "net_price", "return_flag",
    "ship_date", "ship_mode",
]

FCT_RETURNS_COLUMNS = [
    "order_item_key", "order_key", "line_number", "part_key", "supplier_key",
    "order_date", "customer_key", "customer_nation", "customer_region", "sales_region",
    "part_name", "brand", "supplier_name", "supplier_nation", "returned_quantity",
    "returned_gross_amount", "returned_net_amount", "return_receipt_date",
]


def order_line_rollup(line_items: DataFrame) -> DataFrame:
    """Per-order measures of the line items.

    Partial (map-side) aggregation collapses each order's lines before the
    shuffle, so an order holding a large share of all lines costs one row per
    map task. The discount sum and count are carried so averages can be
    re-aggregated exactly later."""
    li = priced_line_items(line_items)
    return li.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("extended_price").alias("gross_revenue"),
        F.sum("discounted_price").alias("net_revenue"),
        F.sum("net_price").alias("net_revenue_after_tax"),
        F.sum("quantity").alias("total_quantity"),
        F.min("ship_date").alias("first_ship_date"),
        F.max("ship_date").alias("last_ship_date"),
        F.sum("discount_percentage").alias("discount_sum"),
        F.count("discount_percentage").alias("discount_count"),
    )


def fct_orders(orders_enriched: DataFrame, line_items: DataFrame, restrict_to_orders: bool = False) -> DataFrame:
    """One row per order with its line-item rollup; orders without lines keep
    NULL measures.

    ``line_items`` may be staged line items (priced here) or the enriched
    view; only line-item columns are read, so no part / supplier join is
    planned. With ``restrict_to_orders`` (incremental loads) line items are
    semi-joined to the given orders before aggregating."""
    li = priced_line_items(line_items)
    if restrict_to_orders:
        li = li.join(orders_enriched.select("order_key"), "order_key", "left_semi")
    rollup = order_line_rollup(li)
    return (
        orders_enriched.join(rollup, "order_key", "left")
        .withColumn("avg_discount_rate", ratio("discount_sum", "discount_count"))
        .select(*FCT_ORDERS_COLUMNS)
    )


def _order_context(orders_enriched: DataFrame, with_status: bool) -> DataFrame:
    cols = [
        "order_key", "order_date", "customer_key", "customer_nation",
        "customer_region", "sales_region",
    ]
    oc = orders_enriched.select(*cols, F.col("status_code").alias("order_status"))
    return oc if with_status else oc.drop("order_status")


def lines_with_orders(line_items: DataFrame, orders_enriched: DataFrame, with_status: bool = True) -> DataFrame:
    """Lines inner-joined to their order context; lines that carry it already stay as they are."""
    if set(ORDER_CONTEXT_COLUMNS) <= set(line_items.columns):
        return line_items
    return line_items.join(_order_context(orders_enriched, with_status), "order_key", "inner")


def fct_order_items(line_items_enriched: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """One row per line item (inner join to its order) with a surrogate key."""
    return (
        lines_with_orders(line_items_enriched, orders_enriched)
        .withColumn("order_item_key", surrogate_key("order_key", "line_number"))
        .select(*FCT_ORDER_ITEMS_COLUMNS)
    )


def fct_returns(line_items_enriched: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """Returned line items only (return_flag = 'R'); the filter reaches the
    Parquet scan of the line items."""
    returned = line_items_enriched.where(F.col("return_flag") == "R")
    return (
        lines_with_orders(returned, orders_enriched, with_status=False)
        .withColumn("order_item_key", surrogate_key("order_key", "line_number"))
        .select(
            "order_item_key", "order_key", "line_number", "part_key", "supplier_key",
            "order_date", "customer_key", "customer_nation", "customer_region", "sales_region",
            "part_name", "brand", "supplier_name", "supplier_nation",
            F.col("quantity").alias("returned_quantity"),
            F.col("extended_price").alias("returned_gross_amount"),
            F.col("discounted_price").alias("returned_net_amount"),
            F.col("receipt_date").alias("return_receipt_date"),
        )
    )


def order_measures(orders: DataFrame, line_items: DataFrame) -> DataFrame:
    """order_key, customer_key and the line-item rollup of every order: the
    order fact without its customer attributes, for reports that read none."""
    return orders.select("order_key", "customer_key").join(order_line_rollup(line_items), "order_key", "left")


def sold_lines(line_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Priced line items of the given orders with their order date; no
    customer, part or supplier attributes."""
    return priced_line_items(line_items).join(orders.select("order_key", "order_date"), "order_key", "inner")


def order_lines(line_items: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """The line-item fact without part and supplier attributes: priced line
    items inner-joined to their order context. The same rows as
    :func:`fct_order_items` while part and supplier keys are unique (which the
    unique checks on the staged tables assert), without the two dimension
    joins that Catalyst cannot drop on its own."""
    return priced_line_items(line_items).join(_order_context(orders_enriched, True), "order_key", "inner")


def returned_lines(line_items: DataFrame, orders: DataFrame) -> DataFrame:
    """The measures of the returns fact with the order date."""
    return sold_lines(line_items, orders).where(F.col("return_flag") == "R").select(
        "order_key", "line_number", "part_key", "supplier_key", "order_date",
        F.col("quantity").alias("returned_quantity"),
        F.col("extended_price").alias("returned_gross_amount"),
        F.col("discounted_price").alias("returned_net_amount"),
        F.col("receipt_date").alias("return_receipt_date"),
    )
