"""Reference SQL (DuckDB dialect) for the registered queries.

Each statement runs on the raw tables registered as views under their own
names and returns the same columns as the Spark query, with the same stand-in
rules for columns absent from the synthetic extracts. Money is computed in
decimals and cast to double at the end, as on the Spark side."""

from __future__ import annotations

from decimal import Decimal

from sparkmarts.plans.standins import TPCH_NATIONS
from sparkmarts.sources.seeds import FX_RATES, MARKET_SEGMENT_LABELS, NATION_REGION_OVERRIDES

NULL_MARKER = "_surrogate_key_null_"



def _values(rows, take) -> str:
    """A VALUES list of some columns of the fixed rows."""
    quote = lambda v: str(v) if isinstance(v, (int, Decimal)) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(quote(r[i]) for i in take) + ")" for r in rows)


_REGION_OF = {name: (display, region) for name, display, region in NATION_REGION_OVERRIDES}
# the override seed keyed by nation key, for nation tables whose names are codes
_CODED = [(key, *_REGION_OF[name]) for key, name in TPCH_NATIONS if name in _REGION_OF]
_OVERRIDE_VALUES = _values(_CODED, (0, 2))
_LABEL_VALUES = _values(MARKET_SEGMENT_LABELS, (0, 1))

BASE_CTES = f"""
stg_customers AS (
  SELECT c_custkey AS customer_key, c_name AS customer_name, CAST(NULL AS VARCHAR) AS customer_address,
         c_nationkey AS nation_key, CAST(NULL AS VARCHAR) AS phone_number,
         CAST(c_acctbal AS DECIMAL(12,2)) AS account_balance, c_mktsegment AS market_segment,
         CAST(NULL AS VARCHAR) AS customer_comment
  FROM customer),
stg_orders AS (
  SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS status_code,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_price, CAST(o_orderdate AS DATE) AS order_date,
         o_orderpriority AS priority_code, CAST(NULL AS VARCHAR) AS clerk_name,
         CAST(NULL AS INTEGER) AS ship_priority, CAST(NULL AS VARCHAR) AS order_comment
  FROM orders),
stg_line_items AS (
  SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supplier_key, l_linenumber AS line_number,
         CAST(l_quantity AS DECIMAL(12,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_percentage, CAST(l_tax AS DECIMAL(4,2)) AS tax_rate,
         l_returnflag AS return_flag, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(NULL AS DATE) AS commit_date, CAST(NULL AS DATE) AS receipt_date,
         CAST(NULL AS VARCHAR) AS ship_instructions, CAST(NULL AS VARCHAR) AS ship_mode,
         CAST(NULL AS VARCHAR) AS line_item_comment
  FROM lineitem),
stg_parts AS (
  SELECT p_partkey AS part_key, p_name AS part_name, CAST(NULL AS VARCHAR) AS manufacturer, p_brand AS brand,
         p_type AS part_type, p_size AS part_size, CAST(NULL AS VARCHAR) AS container_type,
         CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price, CAST(NULL AS VARCHAR) AS part_comment
  FROM part),
stg_suppliers AS (
  SELECT s_suppkey AS supplier_key, s_name AS supplier_name, CAST(NULL AS VARCHAR) AS supplier_address,
         s_nationkey AS nation_key, CAST(NULL AS VARCHAR) AS phone_number,
         CAST(s_acctbal AS DECIMAL(12,2)) AS account_balance, CAST(NULL AS VARCHAR) AS supplier_comment
  FROM supplier),
stg_part_suppliers AS (
  SELECT l_partkey AS part_key, l_suppkey AS supplier_key,
         CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS INTEGER) AS available_quantity,
         CAST(MIN(l_extendedprice) AS DECIMAL(12,2)) AS supply_cost,
         CAST(NULL AS VARCHAR) AS part_supplier_comment
  FROM lineitem GROUP BY l_partkey, l_suppkey),
stg_nations AS (
  SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key,
         CAST(NULL AS VARCHAR) AS nation_comment
  FROM nation),
stg_regions AS (
  SELECT r_regionkey AS region_key, r_name AS region_name, CAST(NULL AS VARCHAR) AS region_comment
  FROM region),
overrides AS (
  SELECT n.nation_name, v.sales_region
  FROM stg_nations n JOIN (VALUES {_OVERRIDE_VALUES}) AS v(nation_key, sales_region) ON n.nation_key = v.nation_key),
segment_labels AS (
  SELECT * FROM (VALUES {_LABEL_VALUES}) AS l(market_segment, display_label)),
geography AS (
  SELECT n.nation_key, n.nation_name, r.region_name, COALESCE(o.sales_region, r.region_name) AS sales_region
  FROM stg_nations n
  LEFT JOIN stg_regions r ON n.region_key = r.region_key
  LEFT JOIN overrides o ON n.nation_name = o.nation_name),
orders_enriched AS (
  SELECT o.order_key, o.customer_key, o.order_date, o.status_code, o.priority_code, o.total_price,
         o.clerk_name, o.ship_priority, c.customer_name, c.market_segment, c.account_balance,
         g.nation_name AS customer_nation, g.region_name AS customer_region, g.sales_region
  FROM stg_orders o
  LEFT JOIN stg_customers c ON o.customer_key = c.customer_key
  LEFT JOIN geography g ON c.nation_key = g.nation_key),
cents AS (
  SELECT *, CAST(extended_price * 100 AS HUGEINT) AS price_cents, 100 - CAST(discount_percentage * 100 AS HUGEINT) AS kept,
         100 + CAST(tax_rate * 100 AS HUGEINT) AS taxed
  FROM stg_line_items),
priced AS (
  SELECT * EXCLUDE (price_cents, kept, taxed), CAST(price_cents * kept AS DECIMAL(20,0)) * 0.0001 AS discounted_price,
         CAST(price_cents * kept * taxed AS DECIMAL(24,0)) * 0.000001 AS net_price
  FROM cents),
line_items_enriched AS (
  SELECT li.order_key, li.part_key, li.supplier_key, li.line_number, li.quantity, li.extended_price,
         li.discount_percentage, li.tax_rate,
         li.discounted_price, li.net_price, li.return_flag, li.line_status, li.ship_date, li.commit_date, li.receipt_date,
         li.ship_instructions, li.ship_mode,
         p.part_name, p.manufacturer, p.brand, p.part_type, p.retail_price,
         s.supplier_name, sn.nation_name AS supplier_nation
  FROM priced li
  LEFT JOIN stg_parts p ON li.part_key = p.part_key
  LEFT JOIN stg_suppliers s ON li.supplier_key = s.supplier_key
  LEFT JOIN stg_nations sn ON s.nation_key = sn.nation_key),
lines_of_order AS (
  SELECT order_key, list(price_cents) AS prices, list(price_cents * kept) AS nets, list(price_cents * kept * taxed) AS totals,
         list(CAST(quantity * 100 AS HUGEINT)) AS amounts, list(100 - kept) AS rates, list(ship_date) AS days
  FROM cents GROUP BY order_key),
fct_orders AS (
  SELECT e.* EXCLUDE (ship_priority, account_balance), len(x.days) AS line_item_count,
         CAST(list_sum(x.prices) AS DECIMAL(20,0)) * 0.01 AS gross_revenue,
         CAST(list_sum(x.nets) AS DECIMAL(22,0)) * 0.0001 AS net_revenue,
         CAST(list_sum(x.totals) AS DECIMAL(24,0)) * 0.000001 AS net_revenue_after_tax,
         CAST(list_sum(x.amounts) AS DECIMAL(20,0)) * 0.01 AS total_quantity,
         (CAST(list_sum(x.rates) AS DOUBLE) / 100) / NULLIF(list_count(x.rates), 0) AS avg_discount_rate,
         list_min(x.days) AS first_ship_date, list_max(x.days) AS last_ship_date
  FROM orders_enriched e LEFT JOIN lines_of_order x USING (order_key)),
fct_order_items AS (
  SELECT md5(concat_ws('-', COALESCE(CAST(li.order_key AS VARCHAR), '{NULL_MARKER}'),
                            COALESCE(CAST(li.line_number AS VARCHAR), '{NULL_MARKER}'))) AS order_item_key,
         li.order_key, li.line_number, li.part_key, li.supplier_key,
         o.order_date, o.customer_key, o.customer_nation, o.customer_region, o.sales_region,
         o.status_code AS order_status,
         li.part_name, li.brand, li.part_type, li.manufacturer, li.retail_price, li.supplier_name,
         li.supplier_nation, li.quantity, li.extended_price, li.discount_percentage, li.tax_rate,
         li.discounted_price, li.net_price, li.return_flag, li.ship_date, li.ship_mode
  FROM line_items_enriched li JOIN orders_enriched o ON li.order_key = o.order_key),
fct_returns AS (
  SELECT md5(concat_ws('-', COALESCE(CAST(li.order_key AS VARCHAR), '{NULL_MARKER}'),
                            COALESCE(CAST(li.line_number AS VARCHAR), '{NULL_MARKER}'))) AS order_item_key,
         li.order_key, li.line_number, li.part_key, li.supplier_key,
         o.order_date, o.customer_key, o.customer_nation, o.customer_region, o.sales_region,
         li.part_name, li.brand, li.supplier_name, li.supplier_nation,
         li.quantity AS returned_quantity, li.extended_price AS returned_gross_amount,
         li.discounted_price AS returned_net_amount, li.receipt_date AS return_receipt_date
  FROM line_items_enriched li JOIN orders_enriched o ON li.order_key = o.order_key
  WHERE li.return_flag = 'R'),
dim_customers AS (
  SELECT c.customer_key, c.customer_name, c.customer_address, c.phone_number, c.account_balance,
         c.market_segment, COALESCE(l.display_label, c.market_segment) AS market_segment_label,
         g.nation_name, g.region_name, g.sales_region
  FROM stg_customers c
  LEFT JOIN geography g ON c.nation_key = g.nation_key
  LEFT JOIN segment_labels l ON c.market_segment = l.market_segment),
dim_suppliers AS (
  SELECT s.supplier_key, s.supplier_name, s.supplier_address, s.phone_number, s.account_balance,
         g.nation_name, g.region_name, g.sales_region
  FROM stg_suppliers s LEFT JOIN geography g ON s.nation_key = g.nation_key),
part_supplier_stats AS (
  SELECT part_key, COUNT(DISTINCT supplier_key) AS supplier_count, MIN(supply_cost) AS min_supply_cost,
         CAST(SUM(supply_cost) AS DOUBLE) / COUNT(supply_cost) AS avg_supply_cost,
         MAX(supply_cost) AS max_supply_cost, CAST(SUM(available_quantity) AS BIGINT) AS total_available_quantity
  FROM stg_part_suppliers GROUP BY part_key),
dim_parts AS (
  SELECT p.part_key, p.part_name, p.manufacturer, p.brand, p.part_type, p.part_size, p.container_type,
         p.retail_price, COALESCE(s.supplier_count, 0) AS supplier_count, s.min_supply_cost, s.avg_supply_cost,
         s.max_supply_cost, COALESCE(s.total_available_quantity, 0) AS total_available_quantity,
         CAST(p.retail_price AS DOUBLE) - s.avg_supply_cost AS avg_margin
  FROM stg_parts p LEFT JOIN part_supplier_stats s ON p.part_key = s.part_key)
"""


def revenue_cte(name: str, group_col: str, out_col: str, source: str = "fct_order_items", where: str = "") -> str:
    return f"""{name} AS (
  SELECT {group_col} AS {out_col}, CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month, COUNT(DISTINCT order_key) AS order_count,
         SUM(quantity) AS total_quantity, SUM(extended_price) AS gross_revenue,
         SUM(discounted_price) AS net_revenue, SUM(net_price) AS net_revenue_after_tax,
         CAST(SUM(discount_percentage) AS DOUBLE) / COUNT(discount_percentage) AS avg_discount_rate
  FROM {source} {where}
  GROUP BY 1, 2, 3)"""


REVENUE_CTES = (
    revenue_cte("agg_revenue_by_nation", "customer_nation", "nation_name")
    + ",\n"
    + revenue_cte("agg_revenue_by_sales_region", "sales_region", "sales_region")
)


def with_base(final_sql: str, extra_ctes: str = "") -> str:
    ctes = BASE_CTES.rstrip() + ",\n" + REVENUE_CTES
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{final_sql}"


def select_doubles(relation: str, columns: list[str], decimals: set[str]) -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in decimals else c for c in columns)
    return f"SELECT {cols} FROM {relation}"


# (relation, columns, decimal columns) for relations returned as they are.
RELATIONS: dict[str, tuple[str, list[str], set[str]]] = {
    "stg_customers": ("stg_customers", [
        "customer_key", "customer_name", "customer_address", "nation_key", "phone_number",
        "account_balance", "market_segment", "customer_comment"], {"account_balance"}),
    "stg_orders": ("stg_orders", [
        "order_key", "customer_key", "status_code", "total_price", "order_date", "priority_code",
        "clerk_name", "ship_priority", "order_comment"], {"total_price"}),
    "stg_line_items": ("stg_line_items", [
        "order_key", "part_key", "supplier_key", "line_number", "quantity", "extended_price",
        "discount_percentage", "tax_rate", "return_flag", "line_status", "ship_date", "commit_date",
        "receipt_date", "ship_instructions", "ship_mode", "line_item_comment"],
        {"quantity", "extended_price", "discount_percentage", "tax_rate"}),
    "stg_parts": ("stg_parts", [
        "part_key", "part_name", "manufacturer", "brand", "part_type", "part_size", "container_type",
        "retail_price", "part_comment"], {"retail_price"}),
    "stg_suppliers": ("stg_suppliers", [
        "supplier_key", "supplier_name", "supplier_address", "nation_key", "phone_number",
        "account_balance", "supplier_comment"], {"account_balance"}),
    "stg_part_suppliers": ("stg_part_suppliers", [
        "part_key", "supplier_key", "available_quantity", "supply_cost", "part_supplier_comment"],
        {"supply_cost"}),
    "stg_nations": ("stg_nations", ["nation_key", "nation_name", "region_key", "nation_comment"], set()),
    "stg_regions": ("stg_regions", ["region_key", "region_name", "region_comment"], set()),
    "orders_enriched": ("orders_enriched", [
        "order_key", "customer_key", "order_date", "status_code", "priority_code", "total_price",
        "clerk_name", "ship_priority", "customer_name", "market_segment", "account_balance",
        "customer_nation", "customer_region", "sales_region"], {"total_price", "account_balance"}),
    "line_items_enriched": ("line_items_enriched", [
        "order_key", "part_key", "supplier_key", "line_number", "quantity", "extended_price",
        "discount_percentage", "tax_rate", "discounted_price", "net_price", "return_flag", "line_status",
        "ship_date", "commit_date", "receipt_date", "ship_instructions", "ship_mode", "part_name",
        "manufacturer", "brand", "part_type", "retail_price", "supplier_name", "supplier_nation"],
        {"quantity", "extended_price", "discount_percentage", "tax_rate", "discounted_price", "net_price",
         "retail_price"}),
    "fct_orders": ("fct_orders", [
        "order_key", "customer_key", "customer_name", "customer_nation", "customer_region", "sales_region",
        "market_segment", "order_date", "status_code", "priority_code", "total_price", "clerk_name",
        "line_item_count", "gross_revenue", "net_revenue", "net_revenue_after_tax", "total_quantity",
        "avg_discount_rate", "first_ship_date", "last_ship_date"],
        {"total_price", "gross_revenue", "net_revenue", "net_revenue_after_tax", "total_quantity"}),
    "fct_order_items": ("fct_order_items", [
        "order_item_key", "order_key", "line_number", "part_key", "supplier_key", "order_date",
        "customer_key", "customer_nation", "customer_region", "sales_region", "order_status", "part_name",
        "brand", "part_type", "manufacturer", "retail_price", "supplier_name", "supplier_nation", "quantity",
        "extended_price", "discount_percentage", "tax_rate", "discounted_price", "net_price", "return_flag",
        "ship_date", "ship_mode"],
        {"retail_price", "quantity", "extended_price", "discount_percentage", "tax_rate", "discounted_price",
         "net_price"}),
    "fct_returns": ("fct_returns", [
        "order_item_key", "order_key", "line_number", "part_key", "supplier_key", "order_date",
        "customer_key", "customer_nation", "customer_region", "sales_region", "part_name", "brand",
        "supplier_name", "supplier_nation", "returned_quantity", "returned_gross_amount",
        "returned_net_amount", "return_receipt_date"],
        {"returned_quantity", "returned_gross_amount", "returned_net_amount"}),
    "dim_customers": ("dim_customers", [
        "customer_key", "customer_name", "customer_address", "phone_number", "account_balance",
        "market_segment", "market_segment_label", "nation_name", "region_name", "sales_region"],
        {"account_balance"}),
    "dim_suppliers": ("dim_suppliers", [
        "supplier_key", "supplier_name", "supplier_address", "phone_number", "account_balance",
        "nation_name", "region_name", "sales_region"], {"account_balance"}),
    "dim_parts": ("dim_parts", [
        "part_key", "part_name", "manufacturer", "brand", "part_type", "part_size", "container_type",
        "retail_price", "supplier_count", "min_supply_cost", "avg_supply_cost", "max_supply_cost",
        "total_available_quantity", "avg_margin"], {"retail_price", "min_supply_cost", "max_supply_cost"}),
    "revenue_by_nation": ("agg_revenue_by_nation", [
        "nation_name", "order_year", "order_month", "order_count", "total_quantity", "gross_revenue",
        "net_revenue", "net_revenue_after_tax", "avg_discount_rate"],
        {"total_quantity", "gross_revenue", "net_revenue", "net_revenue_after_tax"}),
    "revenue_by_sales_region": ("agg_revenue_by_sales_region", [
        "sales_region", "order_year", "order_month", "order_count", "total_quantity", "gross_revenue",
        "net_revenue", "net_revenue_after_tax", "avg_discount_rate"],
        {"total_quantity", "gross_revenue", "net_revenue", "net_revenue_after_tax"}),
}

ORACLE_SQL: dict[str, str] = {
    key: with_base(select_doubles(rel, cols, decs)) for key, (rel, cols, decs) in RELATIONS.items()
}

_FX_CODES = "[" + ", ".join(f"'{code}'" for code, _, _ in FX_RATES) + ", 'XXX', NULL]"
_FX_VALUES = _values([(code, name, Decimal(rate)) for code, name, rate in FX_RATES], (0, 2))
FX_CTE = f"""fx_rates AS (
  SELECT code AS currency_code, CAST(rate AS DECIMAL(12,6)) AS usd_rate FROM (VALUES {_FX_VALUES}) AS f(code, rate))"""

ORACLE_SQL["dim_dates"] = """
SELECT d AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year_number,
       CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(month(d) AS INTEGER) AS month_number,
       strftime(d, '%Y-%m') AS year_month, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayofweek(d) NOT IN (0, 6) AS is_business_day,
       CAST(date_trunc('month', d) AS DATE) AS month_start
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders)
"""

ORACLE_SQL["segment_label"] = with_base(
    "SELECT c.customer_key, c.market_segment, COALESCE(l.display_label, c.market_segment) AS market_segment_label "
    "FROM stg_customers c LEFT JOIN segment_labels l ON c.market_segment = l.market_segment"
)

ORACLE_SQL["surrogate_key"] = f"""
SELECT l_orderkey AS order_key, l_linenumber AS line_number,
       md5(concat_ws('-', COALESCE(CAST(l_orderkey AS VARCHAR), '{NULL_MARKER}'),
                          COALESCE(CAST(l_linenumber AS VARCHAR), '{NULL_MARKER}'))) AS order_item_key
FROM lineitem
"""

ORACLE_SQL["month_bucket"] = """
SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_date,
       CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS order_month
FROM orders
"""

ORACLE_SQL["cents_to_dollars"] = """
SELECT order_key, line_number, cents AS extended_price_cents,
       CAST(round(CAST(cents AS DECIMAL(28,6)) / 100, 2) AS DOUBLE) AS extended_price_dollars
FROM (SELECT l_orderkey AS order_key, l_linenumber AS line_number,
             CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents FROM lineitem)
"""

ORACLE_SQL["monthly_revenue_trend"] = with_base("""
SELECT now.sales_region, now.order_year, now.order_month, CAST(now.net_revenue AS DOUBLE) AS net_revenue,
       CAST(old.net_revenue AS DOUBLE) AS prev_month_net_revenue,
       CAST(now.net_revenue - old.net_revenue AS DOUBLE) AS mom_delta,
       CAST(now.net_revenue - old.net_revenue AS DOUBLE) / NULLIF(CAST(old.net_revenue AS DOUBLE), 0) AS mom_pct_change
FROM numbered now LEFT JOIN numbered old
  ON old.sales_region IS NOT DISTINCT FROM now.sales_region AND old.nth = now.nth - 1
""", """numbered AS (
  SELECT m.sales_region, m.order_year, m.order_month, m.net_revenue,
         (SELECT COUNT(*) FROM agg_revenue_by_sales_region e
          WHERE e.sales_region IS NOT DISTINCT FROM m.sales_region
            AND e.order_year * 12 + e.order_month <= m.order_year * 12 + m.order_month) AS nth
  FROM agg_revenue_by_sales_region m)""")

ORACLE_SQL["supplier_concentration"] = with_base("""
SELECT sales_region, CAST(COALESCE(list_sum(amounts[1:5]), 0) AS DOUBLE) AS top_5_net_revenue,
       CAST(list_sum(amounts) AS DOUBLE) AS region_net_revenue,
       CAST(COALESCE(list_sum(amounts[1:5]), 0) AS DOUBLE) / NULLIF(CAST(list_sum(amounts) AS DOUBLE), 0) AS top_5_share
FROM (SELECT sales_region, list(amount ORDER BY amount DESC NULLS LAST, supplier_key) AS amounts
      FROM (SELECT e.sales_region, l.supplier_key, SUM(l.discounted_price) AS amount
            FROM priced l JOIN orders_enriched e USING (order_key) GROUP BY ALL)
      GROUP BY 1)
""")

ORACLE_SQL["top_customers"] = with_base("""
SELECT cr.customer_key, d.customer_name, d.market_segment_label, d.nation_name, d.sales_region,
       cr.order_count, CAST(cr.lifetime_net_revenue AS DOUBLE) AS lifetime_net_revenue
FROM (SELECT customer_key, SUM(net_revenue) AS lifetime_net_revenue, COUNT(*) AS order_count FROM fct_orders GROUP BY 1) cr
JOIN dim_customers d ON cr.customer_key = d.customer_key
ORDER BY cr.lifetime_net_revenue DESC NULLS LAST, cr.customer_key
LIMIT 50
""")

ORACLE_SQL["returns_alert"] = with_base("""
SELECT d.return_date, CAST(d.returned_amount AS DOUBLE) AS returned_amount,
       CASE WHEN d.return_date >= f.first_day + 14 THEN CAST(COALESCE(p.prior_sum, 0) AS DOUBLE) / 14.0 END
         AS trailing_avg,
       (d.return_date >= f.first_day + 14) AND (d.returned_amount * 14 > 1.25 * COALESCE(p.prior_sum, 0))
         AS is_alert
FROM daily d
CROSS JOIN (SELECT MIN(return_date) AS first_day FROM daily) f
LEFT JOIN (SELECT d2.return_date, SUM(p2.returned_amount) AS prior_sum
           FROM daily d2 JOIN daily p2
             ON p2.return_date >= d2.return_date - 14 AND p2.return_date <= d2.return_date - 1
           GROUP BY 1) p ON d.return_date = p.return_date
""", """daily AS (
  SELECT CAST(order_date AS DATE) AS return_date, SUM(returned_net_amount) AS returned_amount
  FROM fct_returns WHERE order_date IS NOT NULL GROUP BY 1)""")

ORACLE_SQL["supplier_scorecard"] = with_base("""
SELECT d.supplier_key, d.supplier_name, d.nation_name, d.region_name, d.sales_region,
       CAST(d.account_balance AS DOUBLE) AS account_balance,
       COALESCE(s.line_count, 0) AS line_count, CAST(s.gross_revenue AS DOUBLE) AS gross_revenue,
       CAST(s.net_revenue AS DOUBLE) AS net_revenue, COALESCE(r.returned_line_count, 0) AS returned_line_count,
       CAST(r.returned_quantity AS DOUBLE) AS returned_quantity,
       CAST(r.returned_net_amount AS DOUBLE) AS returned_net_amount,
       CASE WHEN s.net_revenue IS NULL OR s.net_revenue = 0 THEN NULL
            ELSE CAST(r.returned_net_amount AS DOUBLE) / CAST(s.net_revenue AS DOUBLE) END AS return_rate
FROM dim_suppliers d
LEFT JOIN (SELECT supplier_key, COUNT(*) AS line_count, SUM(extended_price) AS gross_revenue,
                  SUM(discounted_price) AS net_revenue FROM fct_order_items GROUP BY 1) s
  ON d.supplier_key = s.supplier_key
LEFT JOIN (SELECT supplier_key, COUNT(*) AS returned_line_count, SUM(returned_quantity) AS returned_quantity,
                  SUM(returned_net_amount) AS returned_net_amount FROM fct_returns GROUP BY 1) r
  ON d.supplier_key = r.supplier_key
""")

ORACLE_SQL["convert_to_usd"] = with_base(f"""
SELECT c.customer_key, c.nation_key, CAST(c.account_balance AS DOUBLE) AS account_balance, c.currency_code,
       CAST(c.account_balance * fx.usd_rate AS DOUBLE) AS account_balance_usd
FROM (SELECT customer_key, nation_key, account_balance, {_FX_CODES}[(nation_key % 13) + 1] AS currency_code
      FROM stg_customers) c
LEFT JOIN fx_rates fx ON c.currency_code = fx.currency_code
""", FX_CTE)


# -- incremental loads: expected end states ------------------------------------------
def _orders_enriched_from(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT o.order_key, o.customer_key, o.order_date, o.status_code, o.priority_code, o.total_price,
         o.clerk_name, o.ship_priority, c.customer_name, c.market_segment, c.account_balance,
         g.nation_name AS customer_nation, g.region_name AS customer_region, g.sales_region
  FROM {src} o
  LEFT JOIN stg_customers c ON o.customer_key = c.customer_key
  LEFT JOIN geography g ON c.nation_key = g.nation_key)"""


LOAD_CTES = (
    """stg_orders2 AS (
  SELECT * REPLACE (CASE WHEN status_code = 'P' AND priority_code = '1-URGENT' THEN DATE '2001-09-01'
                         ELSE order_date END AS order_date)
  FROM stg_orders),
load1_keys AS (
  SELECT order_key FROM stg_orders WHERE order_date < DATE '2000-01-01' AND priority_code <> '5-LOW'),
"""
    + _orders_enriched_from("orders_enriched2", "stg_orders2")
    + """,
hwm AS (SELECT MAX(order_date) AS mark FROM stg_orders WHERE order_key IN (SELECT order_key FROM load1_keys)),
fct_orders2 AS (
  SELECT f.* REPLACE (m.order_date AS order_date) FROM fct_orders f JOIN stg_orders2 m USING (order_key)),
fct_order_items2 AS (
  SELECT f.order_item_key, f.order_key, f.line_number, f.part_key, f.supplier_key, o.order_date, f.customer_key,
         f.customer_nation, f.customer_region, f.sales_region, f.order_status, f.part_name, f.brand, f.part_type,
         f.manufacturer, f.retail_price, f.supplier_name, f.supplier_nation, f.quantity, f.extended_price,
         f.discount_percentage, f.tax_rate, f.discounted_price, f.net_price, f.return_flag, f.ship_date, f.ship_mode
  FROM fct_order_items f JOIN stg_orders2 o ON f.order_key = o.order_key),
fct_returns2 AS (
  SELECT f.order_item_key, f.order_key, f.line_number, f.part_key, f.supplier_key, o.order_date, f.customer_key,
         f.customer_nation, f.customer_region, f.sales_region, f.part_name, f.brand, f.supplier_name,
         f.supplier_nation, f.returned_quantity, f.returned_gross_amount, f.returned_net_amount,
         f.return_receipt_date
  FROM fct_returns f JOIN stg_orders2 o ON f.order_key = o.order_key)"""
)

# Rows after the second load: the batch (dated after the first load's mark)
# plus first-load rows of orders the batch does not replace.
_END_STATE = "WHERE order_date > (SELECT mark FROM hwm) OR order_key IN (SELECT order_key FROM load1_keys)"

for _key, _rel, _spec in [
    ("fct_orders_incremental", "fct_orders2", "fct_orders"),
    ("fct_order_items_incremental", "fct_order_items2", "fct_order_items"),
    ("fct_returns_incremental", "fct_returns2", "fct_returns"),
]:
    _r, _cols, _decs = RELATIONS[_spec]
    ORACLE_SQL[_key] = with_base(select_doubles(_rel, _cols, _decs) + "\n" + _END_STATE, LOAD_CTES)


def _revenue_end_state(group_col: str, out_col: str) -> str:
    ctes = (
        LOAD_CTES
        + ",\n"
        + revenue_cte("agg1", group_col, out_col, "fct_order_items", "WHERE order_date < DATE '2000-01-15'")
        + """,
cutoff AS (SELECT CAST(MAX(make_date(order_year, order_month, 1)) - INTERVAL 1 MONTH AS DATE) AS c FROM agg1),
"""
        + revenue_cte("batch", group_col, out_col, "fct_order_items2", "WHERE order_date >= (SELECT c FROM cutoff)")
        + f""",
end_state AS (
  SELECT * FROM agg1 a
  WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.{out_col} = a.{out_col}
                    AND b.order_year = a.order_year AND b.order_month = a.order_month)
  UNION ALL SELECT * FROM batch)"""
    )
    cols = [out_col, "order_year", "order_month", "order_count", "total_quantity", "gross_revenue",
            "net_revenue", "net_revenue_after_tax", "avg_discount_rate"]
    decs = {"total_quantity", "gross_revenue", "net_revenue", "net_revenue_after_tax"}
    return with_base(select_doubles("end_state", cols, decs), ctes)


ORACLE_SQL["revenue_by_nation_incremental"] = _revenue_end_state("customer_nation", "nation_name")
ORACLE_SQL["revenue_by_sales_region_incremental"] = _revenue_end_state("sales_region", "sales_region")


# -- history: expected versions after two loads --------------------------------------
# Balance bands of the second history load (see scenarios.history_load2).
def _load2_column(c: str) -> str:
    if c == "account_balance":
        return ("CASE WHEN account_balance >= 9000 THEN CAST(account_balance + 100 AS DECIMAL(12,2)) "
                "WHEN account_balance >= 0 AND account_balance < 500 THEN CAST(NULL AS DECIMAL(12,2)) "
                "ELSE account_balance END AS account_balance")
    if c == "phone_number":
        return ("CASE WHEN account_balance >= 500 AND account_balance < 1000 THEN 'changed' "
                "ELSE phone_number END AS phone_number")
    return c


LOAD1_WHERE = "WHERE NOT (account_balance < 0)"
LOAD2_WHERE = "WHERE NOT (account_balance >= 1000 AND account_balance < 1500)"


def _history_sql(stg: str, key: str, columns: list[str], check: list[str]) -> str:
    cols = ", ".join(columns)
    differs = " OR ".join(f"l1.{c} IS DISTINCT FROM l2.{c}" for c in check)
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == "account_balance" else c for c in columns)
    return f"""WITH {BASE_CTES.rstrip()},
l1 AS (SELECT {cols} FROM {stg} {LOAD1_WHERE}),
l2 AS (SELECT {", ".join(_load2_column(c) for c in columns)} FROM {stg} {LOAD2_WHERE}),
changed AS (SELECT l1.{key} FROM l1 JOIN l2 ON l1.{key} = l2.{key} WHERE {differs}),
versions AS (
  SELECT {cols}, md5(concat_ws('|', CAST({key} AS VARCHAR), '2024-01-01 00:00:00')) AS scd_id,
         TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
         CASE WHEN {key} IN (SELECT {key} FROM changed) THEN TIMESTAMP '2024-01-02 00:00:00' END AS valid_to,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM l1
  UNION ALL
  SELECT {cols}, md5(concat_ws('|', CAST({key} AS VARCHAR), '2024-01-02 00:00:00')) AS scd_id,
         TIMESTAMP '2024-01-02 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
         TIMESTAMP '2024-01-02 00:00:00' AS updated_at
  FROM l2
  WHERE {key} IN (SELECT {key} FROM changed) OR {key} NOT IN (SELECT {key} FROM l1))
SELECT {sel}, scd_id, valid_from, valid_to, updated_at FROM versions
"""


ORACLE_SQL["snapshot_customers"] = _history_sql(
    "stg_customers", "customer_key",
    ["customer_key", "customer_name", "customer_address", "nation_key", "phone_number", "account_balance",
     "market_segment"],
    ["account_balance", "market_segment", "customer_address"],
)
ORACLE_SQL["snapshot_suppliers"] = _history_sql(
    "stg_suppliers", "supplier_key",
    ["supplier_key", "supplier_name", "supplier_address", "nation_key", "phone_number", "account_balance"],
    ["account_balance", "supplier_address"],
)


# -- data quality ------------------------------------------------------------------------
DQ_CTES = f"""dq_customers AS (
  SELECT * REPLACE (CASE WHEN account_balance < 0 THEN NULL ELSE customer_name END AS customer_name)
  FROM stg_customers),
dq_orders AS (
  SELECT * REPLACE (CASE WHEN status_code = 'P' AND priority_code = '4-NOT SPECIFIED' THEN 'X'
                         ELSE status_code END AS status_code)
  FROM stg_orders),
planted_items AS (
  SELECT * REPLACE (CASE WHEN quantity = 50 THEN CAST(-0.05 AS DECIMAL(4,2)) ELSE discount_percentage END
                    AS discount_percentage)
  FROM stg_line_items),
planted_summary AS (
  SELECT order_key, SUM(extended_price) AS gross_revenue,
         SUM(extended_price * (1 - discount_percentage)) AS net_revenue
  FROM planted_items GROUP BY order_key),
dq_fct_orders AS (
  SELECT o.order_key, o.order_date, o.sales_region, o.status_code, s.gross_revenue, s.net_revenue
  FROM orders_enriched o LEFT JOIN planted_summary s ON o.order_key = s.order_key),
customers_with_currency AS (
  SELECT customer_key, nation_key, {_FX_CODES}[(nation_key % 13) + 1] AS currency_code FROM stg_customers),
{FX_CTE}"""

_CUSTOMER_COLS = RELATIONS["stg_customers"][1]
_ORDER_COLS = RELATIONS["stg_orders"][1]

ORACLE_SQL["dq_not_null"] = with_base(
    select_doubles("dq_customers", _CUSTOMER_COLS, {"account_balance"}) + " WHERE customer_name IS NULL", DQ_CTES
)
ORACLE_SQL["dq_unique"] = with_base(
    "SELECT order_item_key, COUNT(*) AS n_records FROM fct_order_items WHERE order_item_key IS NOT NULL "
    "GROUP BY 1 HAVING COUNT(*) > 1"
)
ORACLE_SQL["dq_relationships"] = with_base(
    select_doubles("stg_orders o", _ORDER_COLS, {"total_price"})
    + " WHERE o.customer_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_customers c "
    "WHERE NOT (c.account_balance < 0) AND c.customer_key = o.customer_key)"
)
ORACLE_SQL["dq_accepted_values"] = with_base(
    "SELECT status_code, COUNT(*) AS n_records FROM dq_orders WHERE status_code NOT IN ('O', 'F', 'P') GROUP BY 1",
    DQ_CTES,
)
ORACLE_SQL["dq_not_negative"] = with_base(
    select_doubles("stg_customers", _CUSTOMER_COLS, {"account_balance"}) + " WHERE account_balance < 0"
)
ORACLE_SQL["dq_valid_currency_code"] = with_base(
    "SELECT customer_key, nation_key, currency_code FROM customers_with_currency c WHERE currency_code IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM fx_rates f WHERE f.currency_code = c.currency_code)",
    DQ_CTES,
)
ORACLE_SQL["dq_gross_gte_net"] = with_base(
    "SELECT order_key, CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(net_revenue AS DOUBLE) AS net_revenue "
    "FROM dq_fct_orders WHERE net_revenue > gross_revenue",
    DQ_CTES,
)
ORACLE_SQL["dq_months_complete"] = with_base(
    "SELECT nation_name, order_year, COUNT(DISTINCT order_month) AS month_count FROM agg_revenue_by_nation "
    "WHERE order_year < (SELECT MAX(order_year) FROM agg_revenue_by_nation) GROUP BY 1, 2 "
    "HAVING COUNT(DISTINCT order_month) <> 12"
)

# relation names of the check suite -> relations of the oracle
_DQ_RELATIONS = {
    "stg_customers": "dq_customers", "stg_orders": "dq_orders", "fct_orders": "dq_fct_orders",
    "seed.fx_rates": "fx_rates", "seed.nation_region_overrides": "coded_overrides",
    "seed.market_segment_labels": "label_rows", "dim_dates": "day_rows", "snp_customers": "customer_history",
    "snp_suppliers": "supplier_history",
}
_NOT_IN_EXTRACTS = {"source.partsupp"}


def _check_sql(check) -> str:
    rel = _DQ_RELATIONS.get(check.relation, check.relation.removeprefix("source."))
    col = check.column
    head = (
        f"SELECT '{check.name}' AS check_name, '{check.relation}' AS relation, '{col}' AS column_name, "
        f"'{check.severity}' AS severity, "
    )
    if check.relation in _NOT_IN_EXTRACTS:
        return head + "CAST(NULL AS BIGINT) AS failures"
    if check.kind == "not_null":
        return head + f"COUNT(*) FILTER (WHERE {col} IS NULL) AS failures FROM {rel}"
    if check.kind == "not_negative":
        return head + f"COUNT(*) FILTER (WHERE {col} < 0) AS failures FROM {rel}"
    if check.kind == "unique":
        return head + (
            f"(SELECT COUNT(*) FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL GROUP BY 1 "
            f"HAVING COUNT(*) > 1)) AS failures"
        )
    if check.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.values)
        return head + f"(SELECT COUNT(DISTINCT {col}) FROM {rel} WHERE {col} NOT IN ({vals})) AS failures"
    if check.kind in ("relationships", "valid_currency_code"):
        parent = _DQ_RELATIONS.get(check.parent, check.parent)
        pcol = check.parent_column or "currency_code"
        return head + (
            f"(SELECT COUNT(*) FROM {rel} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})) AS failures"
        )
    raise ValueError(check.kind)


def dq_report_sql(checks) -> str:
    body = "\nUNION ALL\n".join(_check_sql(c) for c in checks)
    more = f"""{DQ_CTES},
coded_overrides AS (
  SELECT n.n_name AS nation_name, v.sales_region
  FROM nation n JOIN (VALUES {_OVERRIDE_VALUES}) AS v(nation_key, sales_region) ON n.n_nationkey = v.nation_key),
label_rows AS (
  SELECT * FROM (VALUES {_values(MARKET_SEGMENT_LABELS, (0, 3))}) AS l(market_segment, priority_tier)),
day_rows AS ({ORACLE_SQL["dim_dates"]}),
customer_history AS ({ORACLE_SQL["snapshot_customers"]}),
supplier_history AS ({ORACLE_SQL["snapshot_suppliers"]})"""
    return with_base(
        "SELECT *, CASE WHEN failures IS NULL THEN 'skipped' WHEN failures = 0 THEN 'pass' ELSE severity END AS status "
        "FROM (\n" + body + "\n)", more
    )


# -- freshness, change detection, landing -------------------------------------------------
_FRESH_CASES = [
    ("events", None, 48, 168), ("events_without_errors", "event_type <> 'error'", 48, 168),
    ("events_strict", None, 12, 24), ("events_lenient", None, 72, 168),
]
_NOW = "TIMESTAMP '2024-02-03 00:00:00'"
ORACLE_SQL["freshness_by_column"] = (
    "SELECT source_name, max_loaded_at, " + _NOW + " AS snapshotted_at,\n"
    "  CAST(epoch_us(" + _NOW + ") - epoch_us(max_loaded_at) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS age_hours,\n"
    "  warn_after_hours, error_after_hours,\n"
    "  CASE WHEN max_loaded_at IS NULL THEN 'error'\n"
    "       WHEN epoch_us(" + _NOW + ") - epoch_us(max_loaded_at) > CAST(error_after_hours * 3600000000 AS BIGINT) THEN 'error'\n"
    "       WHEN epoch_us(" + _NOW + ") - epoch_us(max_loaded_at) > CAST(warn_after_hours * 3600000000 AS BIGINT) THEN 'warn'\n"
    "       ELSE 'pass' END AS status\n"
    "FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS source_name, CAST(MAX(ts) AS TIMESTAMP) AS max_loaded_at, CAST({w} AS DOUBLE) AS warn_after_hours, "
        f"CAST({e} AS DOUBLE) AS error_after_hours FROM events" + (f" WHERE {f}" if f else "")
        for n, f, w, e in _FRESH_CASES
    )
    + "\n)"
)

_CUST_ALL = _CUSTOMER_COLS
ORACLE_SQL["table_diff"] = with_base(
    "SELECT COALESCE(b.customer_key, a.customer_key) AS customer_key,\n"
    "  CASE WHEN b.customer_key IS NULL THEN 'added' WHEN a.customer_key IS NULL THEN 'removed' ELSE 'changed' END AS change_type\n"
    "FROM l1 b FULL OUTER JOIN l2 a ON b.customer_key = a.customer_key\n"
    "WHERE b.customer_key IS NULL OR a.customer_key IS NULL OR "
    + " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in _CUST_ALL if c != "customer_key"),
    f"l1 AS (SELECT * FROM stg_customers {LOAD1_WHERE}),\n"
    f"l2 AS (SELECT {', '.join(_load2_column(c) for c in _CUST_ALL)} FROM stg_customers {LOAD2_WHERE})",
)

ORACLE_SQL["table_diff_stored"] = ORACLE_SQL["table_diff"]

_LAND_STEPS = [
    (1, t, "created") for t in ["customer", "orders", "lineitem", "supplier", "part", "nation", "region"]
] + [(2, "customer", "skipped"), (2, "nation", "skipped"), (3, "orders", "replaced")]
ORACLE_SQL["land_tables"] = "\nUNION ALL\n".join(
    f"SELECT {s} AS step, '{t}' AS table_name, '{a}' AS action, COUNT(*) AS row_count FROM {t}"
    for s, t, a in _LAND_STEPS
)

ORACLE_SQL["append_next_keys"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS TIMESTAMP) AS loaded_at
FROM orders
UNION ALL
SELECT (SELECT MAX(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS o_orderkey,
       o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'
"""


# -- fingerprint, file freshness, reloads, replaced tables, stored failures ------------------
def _fingerprint_sql(relation: str, columns: list[str], group: str) -> str:
    text = " || ".join(f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return (
        f"SELECT {group}, COUNT(*) AS row_count, bit_xor(h) AS hash_xor, CAST(SUM(h) AS VARCHAR) AS hash_sum "
        f"FROM (SELECT {group}, CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) AS h FROM {relation}) "
        "GROUP BY 1"
    )


ORACLE_SQL["table_fingerprint"] = with_base(
    _fingerprint_sql("stg_line_items", RELATIONS["stg_line_items"][1], "return_flag")
)
_FILE_TABLES = ["customer", "orders", "lineitem", "supplier", "part", "nation", "region"]
ORACLE_SQL["freshness_by_files"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS source_name, '{clock}' AS clock, '{status}' AS status"
    for t in _FILE_TABLES for clock, status in (("2000-01-01", "pass"), ("2200-01-01", "error"))
)
ORACLE_SQL["freshness_configured"] = """
SELECT 'orders' AS source_name, TIMESTAMP '2024-01-01 00:00:00' AS max_loaded_at,
       CAST(48 AS DOUBLE) AS warn_after_hours, CAST(168 AS DOUBLE) AS error_after_hours, 'error' AS status
FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' HAVING COUNT(*) > 0
"""
ORACLE_SQL["reload_table"] = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS method, '{t}' AS table_name, COUNT(*) AS row_count, CAST(SUM({k}) AS BIGINT) AS key_sum FROM {t}"
    for m in ("truncate_reload", "recreate") for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"))
)
ORACLE_SQL["save_table"] = """
SELECT o_orderstatus AS status_code, COUNT(*) AS row_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
"""
ORACLE_SQL["store_failures"] = with_base(
    select_doubles("dq_customers", _CUSTOMER_COLS, {"account_balance"}) + " WHERE customer_name IS NULL", DQ_CTES
)


def _register_dq_report() -> None:
    from sparkmarts.plans.catalog import dq_suite

    ORACLE_SQL["dq_report"] = dq_report_sql(dq_suite().checks)


_register_dq_report()


# -- seeds applied to the given tables ---------------------------------------------------
ORACLE_SQL["seed_nation_regions"] = f"""
SELECT n.n_name AS nation_name, v.display_name, v.sales_region
FROM nation n JOIN (VALUES {_values(_CODED, (0, 1, 2))}) AS v(nation_key, display_name, sales_region)
  ON n.n_nationkey = v.nation_key
"""

ORACLE_SQL["seed_segment_labels"] = f"""
SELECT s.market_segment, l.display_label, l.industry_group, CAST(l.priority_tier AS INTEGER) AS priority_tier
FROM (SELECT DISTINCT c_mktsegment AS market_segment FROM customer) s
LEFT JOIN (VALUES {_values(MARKET_SEGMENT_LABELS, (0, 1, 2, 3))}) AS l(market_segment, display_label, industry_group, priority_tier)
  ON s.market_segment = l.market_segment
"""

ORACLE_SQL["seed_fx_rates"] = f"""
SELECT c.currency_code, f.currency_name, CAST(CAST(f.usd_rate AS DECIMAL(12,6)) AS DOUBLE) AS usd_rate
FROM (SELECT DISTINCT {_FX_CODES}[(c_nationkey % 13) + 1] AS currency_code FROM customer) c
LEFT JOIN (VALUES {_values([(c, n, Decimal(r)) for c, n, r in FX_RATES], (0, 1, 2))}) AS f(currency_code, currency_name, usd_rate) ON c.currency_code = f.currency_code
"""
