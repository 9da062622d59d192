"""Staging: 1:1 rename and typing of the raw tables.

Staging a table is a single projection, so Catalyst prunes the scan to
the columns a downstream query actually uses and pushes filters through it.
``fill_missing=True`` replaces raw columns absent from the input with typed
NULLs (for partial extracts); the default is strict and raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from sparkmarts.settings import MONEY, RATE

# source table -> [(raw column, staged column, type)]
STAGING_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "customer": [
        ("c_custkey", "customer_key", "bigint"),
        ("c_name", "customer_name", "string"),
        ("c_address", "customer_address", "string"),
        ("c_nationkey", "nation_key", "int"),
        ("c_phone", "phone_number", "string"),
        ("c_acctbal", "account_balance", MONEY),
        ("c_mktsegment", "market_segment", "string"),
        ("c_comment", "customer_comment", "string"),
    ],
    "orders": [
        ("o_orderkey", "order_key", "bigint"),
        ("o_custkey", "customer_key", "bigint"),
        ("o_orderstatus", "status_code", "string"),
        ("o_totalprice", "total_price", MONEY),
        ("o_orderdate", "order_date", "date"),
        ("o_orderpriority", "priority_code", "string"),
        ("o_clerk", "clerk_name", "string"),
        ("o_shippriority", "ship_priority", "int"),
        ("o_comment", "order_comment", "string"),
    ],
    "lineitem": [
        ("l_orderkey", "order_key", "bigint"),
        ("l_partkey", "part_key", "bigint"),
        ("l_suppkey", "supplier_key", "bigint"),
        ("l_linenumber", "line_number", "int"),
        ("l_quantity", "quantity", MONEY),
        ("l_extendedprice", "extended_price", MONEY),
        ("l_discount", "discount_percentage", RATE),
        ("l_tax", "tax_rate", RATE),
        ("l_returnflag", "return_flag", "string"),
        ("l_linestatus", "line_status", "string"),
        ("l_shipdate", "ship_date", "date"),
        ("l_commitdate", "commit_date", "date"),
        ("l_receiptdate", "receipt_date", "date"),
        ("l_shipinstruct", "ship_instructions", "string"),
        ("l_shipmode", "ship_mode", "string"),
        ("l_comment", "line_item_comment", "string"),
    ],
    "part": [
        ("p_partkey", "part_key", "bigint"),
        ("p_name", "part_name", "string"),
        ("p_mfgr", "manufacturer", "string"),
        ("p_brand", "brand", "string"),
        ("p_type", "part_type", "string"),
        ("p_size", "part_size", "int"),
        ("p_container", "container_type", "string"),
        ("p_retailprice", "retail_price", MONEY),
        ("p_comment", "part_comment", "string"),
    ],
    "supplier": [
        ("s_suppkey", "supplier_key", "bigint"),
        ("s_name", "supplier_name", "string"),
        ("s_address", "supplier_address", "string"),
        ("s_nationkey", "nation_key", "int"),
        ("s_phone", "phone_number", "string"),
        ("s_acctbal", "account_balance", MONEY),
        ("s_comment", "supplier_comment", "string"),
    ],
    "partsupp": [
        ("ps_partkey", "part_key", "bigint"),
        ("ps_suppkey", "supplier_key", "bigint"),
        ("ps_availqty", "available_quantity", "int"),
        ("ps_supplycost", "supply_cost", MONEY),
        ("ps_comment", "part_supplier_comment", "string"),
    ],
    "nation": [
        ("n_nationkey", "nation_key", "int"),
        ("n_name", "nation_name", "string"),
        ("n_regionkey", "region_key", "int"),
        ("n_comment", "nation_comment", "string"),
    ],
    "region": [
        ("r_regionkey", "region_key", "int"),
        ("r_name", "region_name", "string"),
        ("r_comment", "region_comment", "string"),
    ],
}


class MissingSourceColumn(ValueError):
    pass


def _exact(value: Column, kind: DataType, typ: str) -> Column:
    """``value`` as ``typ``; a value with more decimals than the type keeps is an
    error, not rounded. Binary fractions may differ by their own error."""
    out = value.cast(typ)
    to = DataType.fromDDL(typ)
    if not isinstance(to, DecimalType):
        return out
    if isinstance(kind, (FloatType, DoubleType)):
        units = value.cast("double") * float(10**to.scale)
        lost = F.abs(units - F.rint(units)) > 1e-4 + F.abs(units) * (1e-14 if isinstance(kind, DoubleType) else 1e-6)
    elif isinstance(kind, DecimalType) and kind.scale > to.scale:
        lost = out.cast(kind) != value
    else:
        return out
    return F.when(lost, F.raise_error(F.concat(F.lit(f"no exact {typ}: "), value.cast("string"))).cast(typ)).otherwise(out)


def stage(raw: DataFrame, table: str, fill_missing: bool = False) -> DataFrame:
    """Rename and cast the raw ``table`` to its staged schema."""
    present = set(raw.columns)
    cols = []
    missing = []
    for src, out, typ in STAGING_COLUMNS[table]:
        if src in present:
            cols.append(_exact(F.col(src), raw.schema[src].dataType, typ).alias(out))
        else:
            missing.append(src)
            cols.append(F.lit(None).cast(typ).alias(out))
    if missing and not fill_missing:
        raise MissingSourceColumn(f"{table}: missing columns {missing} (pass fill_missing=True to use NULLs)")
    return raw.select(*cols)
