import datetime as dt
from decimal import Decimal

D = Decimal


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


STG_ORDERS_ENRICHED = (
    "order_key bigint, customer_key bigint, order_date date, status_code string, priority_code string, "
    "total_price decimal(12,2), clerk_name string, ship_priority int, customer_name string, "
    "market_segment string, account_balance decimal(12,2), customer_nation string, customer_region string, "
    "sales_region string"
)
LINE_ITEMS_ENRICHED = (
    "order_key bigint, part_key bigint, supplier_key bigint, line_number int, quantity decimal(12,2), "
    "extended_price decimal(12,2), discount_percentage decimal(4,2), tax_rate decimal(4,2), "
    "discounted_price decimal(18,4), net_price decimal(24,6), return_flag string, line_status string, "
    "ship_date date, commit_date date, receipt_date date, ship_instructions string, ship_mode string, "
    "part_name string, manufacturer string, brand string, part_type string, retail_price decimal(12,2), "
    "supplier_name string, supplier_nation string"
)


def order_row(order_key=1):
    return (order_key, 100, d("2024-01-15"), "F", "1-URGENT", D("500.00"), "Clerk#0001", 0, "Alice",
            "AUTOMOBILE", D("1000.00"), "FRANCE", "EUROPE", "EMEA")


def line_row(line, qty, ext, disc, tax, discounted, net, flag, part=10, supp=20, order_key=1):
    return (order_key, part, supp, line, D(qty), D(ext), D(disc), D(tax), D(discounted), D(net), flag, "F",
            d("2024-01-20"), d("2024-01-18"), d("2024-01-22"), "NONE", "AIR", "widget", "Mfg#1", "Brand#11",
            "STD", D("50.00"), "Sup#1", "GERMANY")
