from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from sparkmarts.operators import aggregates
from sparkmarts.plans.catalog import warehouse


def test_revenue_totals_agree(spark):
    wh = warehouse(spark, SMOKE_DIR)
    a = wh.fct_orders.agg(F.sum("net_revenue")).first()[0]
    b = wh.fct_order_items.agg(F.sum("discounted_price")).first()[0]
    c = wh.revenue_by_nation.agg(F.sum("net_revenue")).first()[0]
    assert a == b == c


def test_rollup_shape_equals_line_level_shape(spark):
    wh = warehouse(spark, SMOKE_DIR)
    fast = wh.revenue_by_sales_region
    plain = aggregates.revenue_by_sales_region(wh.fct_order_items)
    assert fast.count() == plain.count()
    assert fast.exceptAll(plain.select(*fast.columns)).count() == 0


def test_narrow_views_equal_fact_columns(spark):
    wh = warehouse(spark, SMOKE_DIR)
    cols = ["order_key", "line_number", "supplier_key", "order_date", "sales_region", "quantity",
            "extended_price", "discounted_price", "net_price", "return_flag"]
    a, b = wh.order_lines.select(*cols), wh.fct_order_items.select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    rcols = ["order_key", "line_number", "supplier_key", "order_date", "returned_quantity",
             "returned_gross_amount", "returned_net_amount", "return_receipt_date"]
    ra, rb = wh.returned_lines.select(*rcols), wh.fct_returns.select(*rcols)
    assert ra.count() == rb.count() and ra.exceptAll(rb).count() == 0


def test_pushdown_and_pruning(spark):
    wh = warehouse(spark, SMOKE_DIR)
    plan = wh.fct_returns._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    scan = [ln for ln in wh.revenue_by_nation._jdf.queryExecution().executedPlan().toString().splitlines()
            if "FileScan parquet" in ln and "l_orderkey" in ln][0]
    assert "l_comment" not in scan and "l_returnflag" not in scan  # only needed columns are read


def test_scorecard_forms_agree(spark):
    from sparkmarts.operators import reports

    wh = warehouse(spark, SMOKE_DIR)
    one_pass = reports.supplier_scorecard(wh.dim_suppliers, wh.order_lines)
    two_inputs = reports.supplier_scorecard(wh.dim_suppliers, wh.fct_order_items, wh.fct_returns)
    assert one_pass.count() == two_inputs.count()
    assert one_pass.exceptAll(two_inputs.select(*one_pass.columns)).count() == 0
