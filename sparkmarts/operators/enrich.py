"""Enrichment joins: geography resolution, enriched orders and line items,
segment labels.

Reference tables (nations, regions, seeds) and suppliers are broadcast while plan statistics
prove them small; entity-to-entity joins (orders x customers, line items x parts) are left to the planner, which picks sort-merge joins at scale and
lets AQE broadcast them at runtime when a side turns out small, or split
skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.functions.joins import broadcast_reference

#: suppliers are hinted up to this many times the bound of reference tables: a
#: broadcast spares every line a shuffle of its whole row
SUPPLIER_TIMES = 16

LINE_ITEM_ENRICHED_COLUMNS = [
    "order_key", "part_key", "supplier_key", "line_number",
    "quantity", "extended_price", "discount_percentage", "tax_rate",
    "discounted_price", "net_price",
    "return_flag", "line_status", "ship_date", "commit_date", "receipt_date",
    "ship_instructions", "ship_mode",
    "part_name", "manufacturer", "brand", "part_type", "retail_price",
    "supplier_name", "supplier_nation",
]

#: columns of its order that a line may carry before parts and suppliers are joined to it
ORDER_CONTEXT_COLUMNS = ["order_date", "customer_key", "customer_nation", "customer_region", "sales_region", "order_status"]

ORDERS_ENRICHED_COLUMNS = [
    "order_key", "customer_key", "order_date", "status_code", "priority_code",
    "total_price", "clerk_name", "ship_priority", "customer_name",
    "market_segment", "account_balance", "customer_nation", "customer_region",
    "sales_region",
]


def nation_geography(nations: DataFrame, regions: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per nation: nation_key, nation_name, region_name and the sales
    region (override seed by nation name, falling back to the region name).

    While its source tables are proven small, the result carries a broadcast
    hint into every join of an entity table with it: customers are then never
    shuffled by their few nations."""
    # a region table read from files carries its size: the planner decides
    regs = regions.select("region_key", "region_name")
    ovr = overrides.select("nation_name", F.col("sales_region").alias("_override_region"))
    geo = (
        nations.select("nation_key", "nation_name", "region_key")
        .join(regs, "region_key", "left")
        .join(ovr, "nation_name", "left")
        .select(
            "nation_key",
            "nation_name",
            "region_name",
            F.coalesce("_override_region", "region_name").alias("sales_region"),
        )
    )
    return broadcast_reference(geo)


def with_geography(df: DataFrame, geography: DataFrame, nation_key: str = "nation_key") -> DataFrame:
    """Left join of ``df`` to the nation geography (from
    :func:`nation_geography`, which decides on broadcasting).

    Adds nation_name, region_name, sales_region. Rows whose nation is unknown
    or NULL keep NULLs."""
    geo = geography.withColumnRenamed("nation_key", "_geo_nation_key")
    return df.join(geo, df[nation_key] == geo["_geo_nation_key"], "left").drop("_geo_nation_key")


def customer_geography(customers: DataFrame, geography: DataFrame) -> DataFrame:
    """Customers with their geography. The orders join is the planner's choice;
    at scale it is a sort-merge join on customer_key, with AQE splitting skewed
    customers."""
    cust = customers.select("customer_key", "customer_name", "market_segment", "account_balance", "nation_key")
    return with_geography(cust, geography).select(
        "customer_key",
        "customer_name",
        "market_segment",
        "account_balance",
        F.col("nation_name").alias("customer_nation"),
        F.col("region_name").alias("customer_region"),
        "sales_region",
    )


def orders_enriched(orders: DataFrame, customers: DataFrame, geography: DataFrame) -> DataFrame:
    """Orders LEFT JOIN customer geography on customer_key (14 columns)."""
    return orders_with_customer_geography(orders, customer_geography(customers, geography))


def orders_with_customer_geography(orders: DataFrame, customer_geo: DataFrame) -> DataFrame:
    """As :func:`orders_enriched`, reusing a customer geography already built."""
    return orders.join(customer_geo, "customer_key", "left").select(*ORDERS_ENRICHED_COLUMNS)


def priced_line_items(line_items: DataFrame) -> DataFrame:
    """Adds discounted_price = p * (1 - d) and net_price = p * (1 - d) * (1 + t),
    exact decimals (decimal(18,4) and decimal(24,6) for staged types)."""
    if "discounted_price" in line_items.columns:
        return line_items
    p, d, t = F.col("extended_price"), F.col("discount_percentage"), F.col("tax_rate")
    return line_items.withColumn("discounted_price", p * (F.lit(1) - d)).withColumn(
        "net_price", p * (F.lit(1) - d) * (F.lit(1) + t)
    )


def supplier_nations(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
    """supplier_key, supplier_name, supplier_nation."""
    nat = nations.select(F.col("nation_key").alias("_snk"), F.col("nation_name").alias("supplier_nation"))
    sup = suppliers.select("supplier_key", "supplier_name", F.col("nation_key").alias("_sk_nation"))
    named = sup.join(broadcast_reference(nat), sup["_sk_nation"] == nat["_snk"], "left").select(
        "supplier_key", "supplier_name", "supplier_nation"
    )
    return broadcast_reference(named, times=SUPPLIER_TIMES)


def line_items_enriched(
    line_items: DataFrame, parts: DataFrame, suppliers: DataFrame, nations: DataFrame
) -> DataFrame:
    """Line items LEFT parts LEFT suppliers LEFT supplier nation, plus prices,
    which are added after the joins, so that their shuffles do not carry them. Columns of
    their orders that the lines carry already stay."""
    prt = parts.select("part_key", "part_name", "manufacturer", "brand", "part_type", "retail_price")
    sup = supplier_nations(suppliers, nations)
    carried = [c for c in ORDER_CONTEXT_COLUMNS if c in line_items.columns]
    return (
        priced_line_items(line_items.join(prt, "part_key", "left").join(sup, "supplier_key", "left"))
        .select(*LINE_ITEM_ENRICHED_COLUMNS, *carried)
    )


def with_segment_label(
    df: DataFrame,
    labels: DataFrame,
    segment_col: str = "market_segment",
    out_col: str = "market_segment_label",
) -> DataFrame:
    """Display label of a segment code, falling back to the code itself.

    Behaves like a scalar lookup: a row whose code has more than one label is
    an error when it is computed, never a silent fan-out."""
    lab = (
        labels.where(F.col("market_segment").isNotNull())
        .groupBy(F.col("market_segment").alias("_lbl_key"))
        .agg(F.min("display_label").alias("_lbl"), F.count(F.lit(1)).alias("_lbl_n"))
    )
    twice = F.raise_error(F.concat(F.lit("market_segment_labels has more than one label for "), F.col("_lbl_key")))
    return (
        df.join(broadcast_reference(lab), df[segment_col] == lab["_lbl_key"], "left")
        .withColumn(
            out_col, F.when(F.col("_lbl_n") > 1, twice.cast("string")).otherwise(F.coalesce(F.col("_lbl"), F.col(segment_col)))
        )
        .drop("_lbl_key", "_lbl", "_lbl_n")
    )
