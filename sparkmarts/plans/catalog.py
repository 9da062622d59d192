"""Registry of runnable queries: one entry per operator, each a function
``(spark, sf_dir) -> DataFrame`` over the given tables.

Money columns are exact decimals inside the library; the registry casts the
final decimal columns to double so that results compare with other engines
value by value (the oracle SQL does the same)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from sparkmarts.functions.columns import cents_to_dollars, month_start, surrogate_key
from sparkmarts.operators import aggregates, changes, dimensions, facts, freshness, quality, reports, snapshots
from sparkmarts.operators.enrich import with_segment_label
from sparkmarts.operators.incremental import read_fact
from sparkmarts.plans import loads, scenarios, standins
from sparkmarts.plans.warehouse import Warehouse
from sparkmarts.session import scratch_path
from sparkmarts.settings import Freshness
from sparkmarts.sources import landing
from sparkmarts.sources.readers import SOURCE_TABLES, source_exists
from sparkmarts.sources.sinks import save_table, store_failures
from sparkmarts.sources.versions import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return register


def decimals_as_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The synthetic extracts lack several columns and use coded nation names.

    One Warehouse per (application, folder): its lazy plans are shared by all
    queries, as when one job builds every mart."""
    key = (spark.sparkContext.applicationId, sf_dir)
    wh = _WAREHOUSES.get(key)
    if wh is None:
        wh = _WAREHOUSES[key] = Warehouse(spark, sf_dir, fill_missing=True, coded_nation_names=True)
    return wh


# -- staging -----------------------------------------------------------------
def _staged(attr: str) -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_as_double(getattr(warehouse(spark, sf_dir), attr))

    fn.__name__ = f"stg_{attr}"
    return fn


for _key, _attr in [
    ("stg_customers", "customers"),
    ("stg_orders", "orders"),
    ("stg_line_items", "line_items"),
    ("stg_parts", "parts"),
    ("stg_suppliers", "suppliers"),
    ("stg_part_suppliers", "part_suppliers"),
    ("stg_nations", "nations"),
    ("stg_regions", "regions"),
    ("orders_enriched", "orders_enriched"),
    ("line_items_enriched", "line_items_enriched"),
    ("fct_orders", "fct_orders"),
    ("fct_order_items", "fct_order_items"),
    ("fct_returns", "fct_returns"),
    ("dim_customers", "dim_customers"),
    ("dim_suppliers", "dim_suppliers"),
    ("dim_parts", "dim_parts"),
    ("revenue_by_nation", "revenue_by_nation"),
    ("revenue_by_sales_region", "revenue_by_sales_region"),
]:
    QUERIES[_key] = _staged(_attr)


# -- dimensions and helpers ----------------------------------------------------


@query("dim_dates")
def q_dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day dimension spanning the order dates of the given orders table."""
    wh = warehouse(spark, sf_dir)
    bounds = wh.orders.agg(
        F.min("order_date").alias("start"), F.date_add(F.max("order_date"), 1).alias("end")
    )
    return dimensions.dim_dates_for_range(bounds, "start", "end")


@query("segment_label")
def q_segment_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    return with_segment_label(wh.customers.select("customer_key", "market_segment"), wh.segment_labels)


@query("surrogate_key")
def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = warehouse(spark, sf_dir).line_items
    return li.select("order_key", "line_number", surrogate_key("order_key", "line_number").alias("order_item_key"))


@query("month_bucket")
def q_month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = warehouse(spark, sf_dir).orders
    return o.select("order_key", "order_date", month_start("order_date").alias("order_month"))


@query("cents_to_dollars")
def q_cents_to_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = warehouse(spark, sf_dir).line_items
    cents = (F.col("extended_price") * 100).cast("bigint")
    return decimals_as_double(
        li.select("order_key", "line_number", cents.alias("extended_price_cents")).withColumn(
            "extended_price_dollars", cents_to_dollars("extended_price_cents", 2)
        )
    )


# -- reports -------------------------------------------------------------------
@query("monthly_revenue_trend")
def q_monthly_revenue_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(reports.monthly_revenue_trend(warehouse(spark, sf_dir).revenue_by_sales_region))


@query("supplier_concentration")
def q_supplier_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(reports.supplier_concentration(warehouse(spark, sf_dir).order_lines))


@query("top_customers")
def q_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    return decimals_as_double(reports.top_customers(wh.order_measures, wh.dim_customers, 50))


@query("returns_alert")
def q_returns_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts have no receipt date: the order date stands in."""
    wh = warehouse(spark, sf_dir)
    return decimals_as_double(reports.returns_alert(wh.returned_lines, date_col="order_date"))


@query("supplier_scorecard")
def q_supplier_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    return decimals_as_double(reports.supplier_scorecard(wh.dim_suppliers, wh.sold_lines))


@query("convert_to_usd")
def q_convert_to_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    cust = standins.with_local_currency(wh.customers.select("customer_key", "nation_key", "account_balance"))
    return decimals_as_double(
        reports.convert_to_usd(cust, "account_balance", "currency_code", wh.fx_rates, "account_balance_usd")
    )


# -- incremental loads -----------------------------------------------------------


def _two_order_loads(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    return scenarios.orders_load1(wh.orders), scenarios.orders_load2(wh.orders)


@query("fct_orders_incremental")
def q_fct_orders_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    path = scratch_path(spark, "fct_orders")
    o1, o2 = _two_order_loads(wh)
    for o in (o1, o2):
        loads.load_fct_orders(spark, o, wh.line_items, path, enrich_orders=wh.enrich_orders)
    return decimals_as_double(read_fact(spark, path))


@query("fct_order_items_incremental")
def q_fct_order_items_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    path = scratch_path(spark, "fct_order_items")
    o1, o2 = _two_order_loads(wh)
    for o in (o1, o2):
        loads.load_fct_order_items(
            spark, wh.line_items, o, path, enrich=wh.enrich_line_items, enrich_orders=wh.enrich_orders
        )
    return decimals_as_double(read_fact(spark, path))


@query("fct_returns_incremental")
def q_fct_returns_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    path = scratch_path(spark, "fct_returns")
    o1, o2 = _two_order_loads(wh)
    for o in (o1, o2):
        loads.load_fct_returns(
            spark, wh.line_items, o, path, enrich=wh.enrich_line_items, enrich_orders=wh.enrich_orders
        )
    return decimals_as_double(read_fact(spark, path))


def _revenue_incremental(spark: SparkSession, sf_dir: str, loader, name: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    path = scratch_path(spark, name)
    items1 = wh.fct_order_items.where(F.col("order_date") < F.lit(scenarios.AGG_LOAD1_BEFORE))
    _, o2 = _two_order_loads(wh)
    items2 = facts.fct_order_items(wh.line_items_enriched, wh.enrich_orders(o2))
    loader(spark, items1, path)
    loader(spark, items2, path)
    return decimals_as_double(read_table(spark, path))


@query("revenue_by_nation_incremental")
def q_revenue_by_nation_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revenue_incremental(spark, sf_dir, loads.load_revenue_by_nation, "agg_revenue_by_nation")


@query("revenue_by_sales_region_incremental")
def q_revenue_by_sales_region_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revenue_incremental(spark, sf_dir, loads.load_revenue_by_sales_region, "agg_revenue_by_sales_region")


# -- history -------------------------------------------------------------------------
def _history(spark: SparkSession, entities: DataFrame, spec: dict, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    key = spec["key"]
    for load, ts in [
        (scenarios.history_load1(entities), scenarios.SNAPSHOT_T1),
        (scenarios.history_load2(entities), scenarios.SNAPSHOT_T2),
    ]:
        snapshots.snapshot_check(spark, load, path, key, spec["check"], ts, spec["columns"])
    return decimals_as_double(snapshots.read_snapshot(spark, path))


@query("snapshot_customers")
def q_snapshot_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, warehouse(spark, sf_dir).customers, snapshots.CUSTOMER_SNAPSHOT, "snp_customers")


@query("snapshot_suppliers")
def q_snapshot_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, warehouse(spark, sf_dir).suppliers, snapshots.SUPPLIER_SNAPSHOT, "snp_suppliers")


# -- data quality --------------------------------------------------------------------


@query("dq_not_null")
def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = scenarios.planted_null_names(warehouse(spark, sf_dir).customers)
    return decimals_as_double(quality.not_null_failures(cust, "customer_name"))


@query("dq_unique")
def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_failures(warehouse(spark, sf_dir).fct_order_items, "order_item_key")


@query("dq_relationships")
def q_dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    parents = scenarios.history_load1(wh.customers)
    return decimals_as_double(quality.relationships_failures(wh.orders, "customer_key", parents, "customer_key"))


@query("dq_accepted_values")
def q_dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = scenarios.planted_status(warehouse(spark, sf_dir).orders)
    return quality.accepted_values_failures(orders, "status_code", ["O", "F", "P"])


@query("dq_not_negative")
def q_dq_not_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(quality.not_negative_failures(warehouse(spark, sf_dir).customers, "account_balance"))


@query("dq_valid_currency_code")
def q_dq_valid_currency_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    cust = standins.with_local_currency(wh.customers.select("customer_key", "nation_key"))
    return quality.valid_currency_code_failures(cust, "currency_code", wh.fx_rates)


@query("dq_gross_gte_net")
def q_dq_gross_gte_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    fo = facts.order_measures(wh.orders, scenarios.planted_negative_discount(wh.line_items))
    return decimals_as_double(quality.gross_gte_net_failures(fo))


@query("dq_months_complete")
def q_dq_months_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.months_complete_failures(warehouse(spark, sf_dir).revenue_by_nation)


def dq_relations(wh: Warehouse, watch: quality.Watch, store: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """The relations of all declared checks, with planted violations. Marts are stored
    once, each the relation itself; the row checks of a mart, and of the views that it is made
    from, are counted by ``watch`` while it is written. Later marts read the stored ones;
    those that do not depend on each other are written at the same time."""
    spark, root = wh.spark, wh.root

    def put(name: str, df: DataFrame, *more: str) -> DataFrame:
        # all rows, and the columns that are read again
        used = {c.column for c in dq_suite().checks if c.relation == name and c.kind not in quality.ROW_LEVEL} | set(more)
        return store(name, watch.on(name, df, written=True).select(*(sorted(used) or df.columns[:1])))

    def order_items() -> dict[str, DataFrame]:
        lines = watch.on("line_items_enriched", wh.line_items_enriched)
        items = put(
            "fct_order_items", facts.fct_order_items(lines, watch.on("orders_enriched", wh.orders_enriched)),
            "customer_nation", "sales_region", "order_date", "order_key",
            "quantity", "extended_price", "discounted_price", "net_price", "discount_percentage",
        )
        return {
            "fct_order_items": items,
            "agg_revenue_by_nation": put("agg_revenue_by_nation", aggregates.revenue_by(items, "customer_nation", "nation_name")),
            "agg_revenue_by_sales_region": put("agg_revenue_by_sales_region", aggregates.revenue_by(items, "sales_region", "sales_region")),
        }

    def parts() -> dict[str, DataFrame]:
        stored = put("stg_part_suppliers", wh.part_suppliers, *wh.part_suppliers.columns)
        return {"stg_part_suppliers": stored, "dim_parts": put("dim_parts", dimensions.dim_parts(wh.parts, stored))}

    def orders() -> dict[str, DataFrame]:
        planted = scenarios.planted_negative_discount(wh.line_items)
        return {"fct_orders": put("fct_orders", facts.fct_orders(wh.orders_enriched, planted))}

    def returns() -> dict[str, DataFrame]:
        return {"fct_returns": put("fct_returns", wh.fct_returns)}

    def history() -> dict[str, DataFrame]:
        return {"snp_customers": q_snapshot_customers(spark, root), "snp_suppliers": q_snapshot_suppliers(spark, root)}

    rel: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(5) as jobs:
        for made in jobs.map(inheritable_thread_target(spark)(lambda f: f()), (order_items, returns, orders, parts, history)):
            rel |= made
    rel |= {
        "stg_customers": scenarios.planted_null_names(wh.customers),
        "stg_orders": scenarios.planted_status(wh.orders),
        "stg_line_items": wh.line_items,
        "stg_suppliers": wh.suppliers,
        "stg_parts": wh.parts,
        "stg_nations": wh.nations,
        "stg_regions": wh.regions,
        "orders_enriched": wh.orders_enriched,
        "line_items_enriched": wh.line_items_enriched,
        "dim_customers": wh.dim_customers,
        "dim_suppliers": wh.dim_suppliers,
        "dim_dates": q_dim_dates(spark, root),
        "seed.nation_region_overrides": wh.overrides,
        "seed.fx_rates": wh.fx_rates,
        "seed.market_segment_labels": wh.segment_labels,
        "customers_with_currency": standins.with_local_currency(wh.customers.select("customer_key", "nation_key")),
    }
    for t in SOURCE_TABLES:
        if source_exists(spark, root, t):
            rel[f"source.{t}"] = wh.raw(t)
    return rel


def dq_suite() -> quality.CheckSuite:
    """All declared checks, the documented value domains, and the checks of
    the planted violations. The extracts have no partsupp: its checks are skipped."""
    s = quality.declared_checks()
    s.checks += quality.accepted_value_checks().checks
    s.add("not_null", "stg_customers", "customer_name")
    s.add("not_negative", "stg_customers", "account_balance", severity="error")
    s.add("valid_currency_code", "customers_with_currency", "currency_code", parent="seed.fx_rates")
    return s


@query("dq_report")
def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_report(warehouse(spark, sf_dir))


def dq_report(wh: Warehouse) -> DataFrame:
    """The report of all checks, each on the relation that it names."""
    checks = dq_suite().checks
    watch = quality.Watch(checks)

    def store(name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(wh.spark, f"dq-{name}")
        df.write.option("compression", "zstd").parquet(path)
        return wh.spark.read.schema(df.schema).parquet(path)

    relations = dq_relations(wh, watch, store)
    return quality.run_checks(wh.spark, relations, checks, counted=watch.failures())


# -- freshness and change detection -----------------------------------------------------
FRESHNESS_CASES = [
    ("events", None, Freshness(48, 168)),
    ("events_without_errors", "event_type <> 'error'", Freshness(48, 168)),
    ("events_strict", None, Freshness(12, 24)),
    ("events_lenient", None, Freshness(72, 168)),
]


@query("freshness_by_column")
def q_freshness_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = warehouse(spark, sf_dir).raw("events")
    parts = [
        freshness.freshness_by_column(events, name, "ts", scenarios.FRESHNESS_NOW, th, flt)
        for name, flt, th in FRESHNESS_CASES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("freshness_by_files")
def q_freshness_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status by the files' own times at two clocks, one before and one after any file."""
    parts = []
    for clock in (dt.datetime(2000, 1, 1), dt.datetime(2200, 1, 1)):
        report = freshness.freshness_report(spark, sf_dir, LANDED, clock)
        parts.append(report.select("source_name", F.lit(str(clock.date())).alias("clock"), "status"))
    return parts[0].unionByName(parts[1])


@query("freshness_configured")
def q_freshness_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured load-time column and filter, on landed orders to which a batch was appended."""
    dst = _landed_with_batch(spark, sf_dir)
    report = freshness.freshness_report(spark, dst, ["orders"], scenarios.FRESHNESS_NOW)
    return report.select("source_name", "max_loaded_at", "warn_after_hours", "error_after_hours", "status")


@query("table_fingerprint")
def q_table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.table_fingerprint(warehouse(spark, sf_dir).line_items, ["return_flag"])


@query("table_diff")
def q_table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = warehouse(spark, sf_dir).customers
    before = scenarios.history_load1(cust)
    after = scenarios.history_load2(cust)
    return changes.table_diff(before, after, ["customer_key"])


@query("table_diff_stored")
def q_table_diff_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same diff between two stored versions with a fingerprint per key bucket."""
    cust = warehouse(spark, sf_dir).customers
    path = scratch_path(spark, "hashed-customers")
    versions_made = [changes.save_hashed(load(cust), path, ["customer_key"]).number for load in (scenarios.history_load1, scenarios.history_load2)]
    return changes.stored_diff(spark, path, *versions_made)


# -- landing and key allocation -------------------------------------------------------------
LANDED = ["customer", "orders", "lineitem", "supplier", "part", "nation", "region"]


@query("land_tables")
def q_land_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    dst = scratch_path(spark, "landed")
    steps = [
        (1, landing.land_tables(spark, sf_dir, dst, LANDED)),
        (2, landing.land_tables(spark, sf_dir, dst, ["customer", "nation"])),
        (3, landing.land_tables(spark, sf_dir, dst, ["orders"], full_refresh=True)),
    ]
    parts = []
    for step, actions in steps:
        for table, action in actions:
            parts.append(
                read_table(spark, f"{dst}/{table}.parquet").agg(
                    F.lit(step).alias("step"), F.lit(table).alias("table_name"), F.lit(action).alias("action"),
                    F.count(F.lit(1)).alias("row_count"),
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _landed_with_batch(spark: SparkSession, sf_dir: str) -> str:
    """A root whose orders table got a batch of copies with new keys."""
    dst = scratch_path(spark, "landed")
    landing.land_tables(spark, sf_dir, dst, ["orders"])
    target = f"{dst}/orders.parquet"
    batch = read_table(spark, target).where(F.col("o_orderdate") >= F.lit(scenarios.APPEND_BATCH_FROM))
    # materialize the batch first: it is read from the table it is appended to
    batch_path = scratch_path(spark, "append-batch")
    batch.write.parquet(batch_path)
    landing.append_with_next_keys(
        spark, target, spark.read.parquet(batch_path), "o_orderkey", scenarios.APPEND_LOADED_AT, ["o_orderkey"]
    )
    return dst


@query("append_next_keys")
def q_append_next_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{_landed_with_batch(spark, sf_dir)}/orders.parquet")


@query("reload_table")
def q_reload_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and key sums after each way of reloading landed tables."""
    parts = []
    for method in landing.RELOAD_METHODS:
        dst = scratch_path(spark, "reloaded")
        tables = {"customer": "c_custkey", "orders": "o_orderkey"}
        landing.land_tables(spark, sf_dir, dst, list(tables))
        landing.reload_table(spark, sf_dir, dst, list(tables), method)
        for t, key in tables.items():
            parts.append(
                read_table(spark, f"{dst}/{t}.parquet").agg(
                    F.lit(method).alias("method"), F.lit(t).alias("table_name"),
                    F.count(F.lit(1)).alias("row_count"), F.sum(key).alias("key_sum"),
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("save_table")
def q_save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned full replace whose new data lacks one of the old partitions."""
    orders = warehouse(spark, sf_dir).orders
    path = scratch_path(spark, "saved")
    save_table(orders, path, ["status_code"])
    save_table(orders.where("status_code <> 'P'"), path, ["status_code"])
    return read_table(spark, path).groupBy("status_code").agg(F.count(F.lit(1)).alias("row_count"))


@query("store_failures")
def q_store_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows of a check, as stored."""
    cust = scenarios.planted_null_names(warehouse(spark, sf_dir).customers)
    path = scratch_path(spark, "failures")
    store_failures(quality.not_null_failures(cust, "customer_name"), path)
    return decimals_as_double(spark.read.parquet(path))


# -- seeds, as applied to the values that occur in the given tables -----------------------
@query("seed_nation_regions")
def q_seed_nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The override seed rows that apply to the given nation table."""
    return warehouse(spark, sf_dir).overrides


@query("seed_segment_labels")
def q_seed_segment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label seed for each market segment occurring among the customers."""
    wh = warehouse(spark, sf_dir)
    return wh.customers.select("market_segment").distinct().join(wh.segment_labels, "market_segment", "left")


@query("seed_fx_rates")
def q_seed_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fx seed for each currency code occurring among the customers."""
    wh = warehouse(spark, sf_dir)
    codes = standins.with_local_currency(wh.customers.select("nation_key")).select("currency_code").distinct()
    return decimals_as_double(codes.join(wh.fx_rates, "currency_code", "left"))
