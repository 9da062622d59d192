from helpers import D, LINE_ITEMS_ENRICHED, STG_ORDERS_ENRICHED, line_row, order_row

from sparkmarts.operators import facts, quality


def test_fct_orders_rolls_up_line_items(spark):
    orders = spark.createDataFrame([order_row()], STG_ORDERS_ENRICHED)
    items = spark.createDataFrame(
        [
            line_row(1, "2", "100.00", "0.10", "0.05", "90.00", "94.50", "N"),
            line_row(2, "3", "200.00", "0.00", "0.05", "200.00", "210.00", "N", part=11, supp=21),
        ],
        LINE_ITEMS_ENRICHED,
    )
    r = facts.fct_orders(orders, items).collect()
    assert len(r) == 1
    row = r[0]
    assert row.order_key == 1 and row.line_item_count == 2
    assert row.gross_revenue == D("300.00")
    assert row.net_revenue == D("290.00")
    assert row.net_revenue_after_tax == D("304.50")
    assert row.total_quantity == D("5.00")
    assert abs(row.avg_discount_rate - 0.05) < 1e-12
    assert row.customer_name == "Alice" and row.sales_region == "EMEA"


def test_fct_returns_keeps_only_returned_lines(spark):
    orders = spark.createDataFrame([order_row()], STG_ORDERS_ENRICHED)
    items = spark.createDataFrame(
        [
            line_row(1, "2", "100.00", "0.10", "0.05", "90.00", "94.50", "R"),
            line_row(2, "3", "200.00", "0.00", "0.05", "200.00", "210.00", "A"),
            line_row(3, "1", "50.00", "0.00", "0.05", "50.00", "52.50", "N"),
        ],
        LINE_ITEMS_ENRICHED,
    )
    r = facts.fct_returns(items, orders).collect()
    assert len(r) == 1
    row = r[0]
    assert (row.order_key, row.line_number) == (1, 1)
    assert row.returned_quantity == D("2.00")
    assert row.returned_gross_amount == D("100.00")
    assert row.returned_net_amount == D("90.00")


def test_order_without_lines_keeps_null_measures(spark):
    orders = spark.createDataFrame([order_row(1), order_row(2)], STG_ORDERS_ENRICHED)
    items = spark.createDataFrame(
        [line_row(1, "2", "100.00", "0.10", "0.05", "90.00", "94.50", "N")], LINE_ITEMS_ENRICHED
    )
    fo = facts.fct_orders(orders, items)
    rows = {r.order_key: r for r in fo.collect()}
    assert rows[2].line_item_count is None and rows[2].gross_revenue is None and rows[2].avg_discount_rate is None
    assert quality.gross_gte_net_failures(fo).count() == 0


def test_order_items_surrogate_key_and_inner_join(spark):
    orders = spark.createDataFrame([order_row(1)], STG_ORDERS_ENRICHED)
    items = spark.createDataFrame(
        [
            line_row(1, "2", "100.00", "0.10", "0.05", "90.00", "94.50", "N"),
            line_row(1, "2", "100.00", "0.10", "0.05", "90.00", "94.50", "N", order_key=99),
        ],
        LINE_ITEMS_ENRICHED,
    )
    r = facts.fct_order_items(items, orders).collect()
    assert len(r) == 1  # the line of the unknown order 99 is dropped
    import hashlib

    assert r[0].order_item_key == hashlib.md5(b"1-1").hexdigest()
    assert r[0].order_status == "F"
