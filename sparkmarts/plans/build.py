"""Build every mart into a folder: facts and aggregates incrementally,
dimensions by full replacement, type-2 history, then the checks on the
stored tables. A first run is a full build; later runs load what is new.

Layout under ``out_root``: fct_orders, fct_order_items, fct_returns (by
order_month), agg_revenue_by_nation, agg_revenue_by_sales_region (by
order_year, order_month), dim_customers, dim_suppliers, dim_parts, dim_dates,
snp_customers, snp_suppliers, check_failures/<check>, check_report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from sparkmarts.operators import quality, snapshots
from sparkmarts.plans import loads
from sparkmarts.plans.warehouse import Warehouse
from sparkmarts.sources.readers import SOURCE_TABLES, source_exists
from sparkmarts.sources.sinks import save_table
from sparkmarts.sources.versions import read_table

FACTS = ("fct_orders", "fct_order_items", "fct_returns")
AGGREGATES = ("agg_revenue_by_nation", "agg_revenue_by_sales_region")


def build_all(
    spark: SparkSession,
    warehouse: Warehouse,
    out_root: str,
    now: dt.datetime,
    full_refresh: bool = False,
    date_spine: tuple | None = None,
) -> DataFrame:
    """Run the whole build; returns the check report (stored as well)."""
    out = out_root.rstrip("/")
    path = {name: f"{out}/{name}" for name in FACTS + AGGREGATES}
    # a full refresh switches each table to its new contents once they are whole
    fresh = {"full_refresh": full_refresh}
    # each load cuts orders by its mark, and lines by the orders left, before enriching them
    o, lines = warehouse.orders, warehouse.line_items
    on = {"enrich_orders": warehouse.enrich_orders} | fresh
    loads.load_fct_orders(spark, o, lines, path["fct_orders"], **on)
    on["enrich"] = warehouse.enrich_line_items
    loads.load_fct_order_items(spark, lines, o, path["fct_order_items"], **on)
    loads.load_fct_returns(spark, lines, o, path["fct_returns"], **on)

    save_table(warehouse.dim_customers, f"{out}/dim_customers")
    save_table(warehouse.dim_suppliers, f"{out}/dim_suppliers")
    save_table(warehouse.dim_parts, f"{out}/dim_parts")
    start, end = date_spine or (None, None)
    save_table(warehouse.dim_dates(start, end), f"{out}/dim_dates")

    # Aggregates read the stored fact; the look-back prunes its partitions.
    items = read_table(spark, path["fct_order_items"])
    loads.load_revenue_by_nation(spark, items, path["agg_revenue_by_nation"], **fresh)
    loads.load_revenue_by_sales_region(spark, items, path["agg_revenue_by_sales_region"], **fresh)

    snapshots.snapshot_customers(spark, warehouse.customers, f"{out}/snp_customers", now)
    snapshots.snapshot_suppliers(spark, warehouse.suppliers, f"{out}/snp_suppliers", now)

    report = quality.run_checks(
        spark, check_relations(spark, warehouse, out), quality.declared_checks().checks,
        store_failures_to=f"{out}/check_failures",
    )
    save_table(report, f"{out}/check_report")
    return read_table(spark, f"{out}/check_report")


def check_relations(spark: SparkSession, warehouse: Warehouse, out: str) -> dict[str, DataFrame]:
    """Relations the declared checks run on: raw sources present in the raw
    folder, staged tables and enriched views (lazy), stored marts and
    history, and the seeds in use."""
    rel: dict[str, DataFrame] = {}
    for t in SOURCE_TABLES:
        if source_exists(spark, warehouse.root, t):
            rel[f"source.{t}"] = warehouse.raw(t)
    staged = {
        "stg_customers": "customers", "stg_orders": "orders", "stg_line_items": "line_items",
        "stg_parts": "parts", "stg_suppliers": "suppliers", "stg_part_suppliers": "part_suppliers",
        "stg_nations": "nations", "stg_regions": "regions",
        "orders_enriched": "orders_enriched", "line_items_enriched": "line_items_enriched",
    }
    for name, attr in staged.items():
        rel[name] = getattr(warehouse, attr)
    stored = FACTS + AGGREGATES + ("dim_customers", "dim_suppliers", "dim_parts", "dim_dates", "snp_customers", "snp_suppliers")
    for name in stored:
        rel[name] = snapshots.read_snapshot(spark, f"{out}/{name}") if name.startswith("snp_") else read_table(spark, f"{out}/{name}")
    rel["seed.nation_region_overrides"] = warehouse.overrides
    rel["seed.fx_rates"] = warehouse.fx_rates
    rel["seed.market_segment_labels"] = warehouse.segment_labels
    return rel
