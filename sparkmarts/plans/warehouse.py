"""The warehouse as lazily built DataFrames over a folder of raw tables.

``Warehouse(spark, root)`` stages each raw table on first use and exposes the
intermediate views, facts, dimensions and aggregates as properties. Nothing
is computed until an action or a write; shared sub-plans are plain Python
attributes, so one session can build every mart from the same lazy plans.
:func:`sparkmarts.plans.build.build_all` stores the marts and derives the
aggregates and checks from the stored tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sparkmarts.operators import aggregates, dimensions, enrich, facts, staging
from sparkmarts.plans import standins
from sparkmarts.sources.readers import read_source, source_exists
from sparkmarts.sources.seeds import load_seed


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fill_missing: bool = False,
        overrides: DataFrame | None = None,
        segment_labels: DataFrame | None = None,
        fx_rates: DataFrame | None = None,
        part_suppliers: DataFrame | None = None,
        coded_nation_names: bool = False,
    ):
        """``fill_missing``: absent raw columns become typed NULLs.
        ``coded_nation_names``: nation names are codes (``NATION_k``); the
        override seed is re-keyed by nation key (see :mod:`standins`).
        ``part_suppliers``: staged part-supplier rows; derived from line items
        when the raw table is absent and ``fill_missing`` is set."""
        self.spark = spark
        self.root = root
        self.fill_missing = fill_missing
        self._overrides = overrides
        self._labels = segment_labels
        self._fx = fx_rates
        self._part_suppliers = part_suppliers
        self._coded = coded_nation_names

    # -- raw and staged ------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return read_source(self.spark, self.root, name)

    def _stage(self, table: str) -> DataFrame:
        return staging.stage(self.raw(table), table, self.fill_missing)

    @cached_property
    def customers(self) -> DataFrame:
        return self._stage("customer")

    @cached_property
    def orders(self) -> DataFrame:
        return self._stage("orders")

    @cached_property
    def line_items(self) -> DataFrame:
        return self._stage("lineitem")

    @cached_property
    def parts(self) -> DataFrame:
        return self._stage("part")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self._stage("supplier")

    @cached_property
    def nations(self) -> DataFrame:
        return self._stage("nation")

    @cached_property
    def regions(self) -> DataFrame:
        return self._stage("region")

    @cached_property
    def part_suppliers(self) -> DataFrame:
        if self._part_suppliers is not None:
            return self._part_suppliers
        if source_exists(self.spark, self.root, "partsupp") or not self.fill_missing:
            return self._stage("partsupp")
        raw = standins.part_suppliers_from_line_items(self.raw("lineitem"))
        return staging.stage(raw, "partsupp", fill_missing=True)

    # -- seeds ---------------------------------------------------------------
    @cached_property
    def overrides(self) -> DataFrame:
        if self._overrides is not None:
            return self._overrides
        if self._coded:
            return standins.overrides_for_coded_nations(self.spark, self.nations)
        return load_seed(self.spark, "nation_region_overrides")

    @cached_property
    def segment_labels(self) -> DataFrame:
        return self._labels if self._labels is not None else load_seed(self.spark, "market_segment_labels")

    @cached_property
    def fx_rates(self) -> DataFrame:
        return self._fx if self._fx is not None else load_seed(self.spark, "fx_rates")

    # -- intermediate --------------------------------------------------------
    @cached_property
    def geography(self) -> DataFrame:
        return enrich.nation_geography(self.nations, self.regions, self.overrides)

    @cached_property
    def customer_geography(self) -> DataFrame:
        return enrich.customer_geography(self.customers, self.geography)

    def enrich_orders(self, orders: DataFrame) -> DataFrame:
        """Enrich another version of the orders (e.g. an arriving batch)."""
        return enrich.orders_with_customer_geography(orders, self.customer_geography)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return self.enrich_orders(self.orders)

    def enrich_line_items(self, line_items: DataFrame) -> DataFrame:
        """Enrich some of the line items (e.g. those of new orders)."""
        return enrich.line_items_enriched(line_items, self.parts, self.suppliers, self.nations)

    @cached_property
    def line_items_enriched(self) -> DataFrame:
        return self.enrich_line_items(self.line_items)

    def fresh(self) -> "Warehouse":
        """The same warehouse with new file listings."""
        return Warehouse(
            self.spark, self.root, self.fill_missing, self._overrides, self._labels, self._fx,
            self._part_suppliers, self._coded,
        )

    @cached_property
    def order_rollup(self) -> DataFrame:
        return facts.order_line_rollup(self.line_items)

    # -- facts ---------------------------------------------------------------
    @cached_property
    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(self.orders_enriched, self.line_items)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return facts.fct_order_items(self.line_items_enriched, self.orders_enriched)

    @cached_property
    def fct_returns(self) -> DataFrame:
        return facts.fct_returns(self.line_items_enriched, self.orders_enriched)

    @cached_property
    def order_lines(self) -> DataFrame:
        """Narrow line-level fact for reports that need no part / supplier
        attributes (see :func:`facts.order_lines`)."""
        return facts.order_lines(self.line_items, self.orders_enriched)

    @cached_property
    def returned_lines(self) -> DataFrame:
        return facts.returned_lines(self.line_items, self.orders)

    @cached_property
    def sold_lines(self) -> DataFrame:
        return facts.sold_lines(self.line_items, self.orders)

    @cached_property
    def order_measures(self) -> DataFrame:
        return facts.order_measures(self.orders, self.line_items)

    # -- dimensions ----------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.customers, self.geography, self.segment_labels)

    @cached_property
    def dim_suppliers(self) -> DataFrame:
        return dimensions.dim_suppliers(self.suppliers, self.geography)

    @cached_property
    def dim_parts(self) -> DataFrame:
        return dimensions.dim_parts(self.parts, self.part_suppliers)

    def dim_dates(self, start=None, end=None) -> DataFrame:
        return dimensions.dim_dates(self.spark, start, end)

    # -- aggregates ----------------------------------------------------------
    @cached_property
    def revenue_by_nation(self) -> DataFrame:
        """Per-order pre-aggregation, then the join: the shape for full builds."""
        return aggregates.revenue_by_from_rollup(
            self.order_rollup, self.orders_enriched, "customer_nation", "nation_name"
        )

    @cached_property
    def revenue_by_sales_region(self) -> DataFrame:
        return aggregates.revenue_by_from_rollup(
            self.order_rollup, self.orders_enriched, "sales_region", "sales_region"
        )
