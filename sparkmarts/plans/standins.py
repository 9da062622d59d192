"""Stand-ins for gaps in partial extracts (the synthetic test tables lack
partsupp, real nation names and several columns). Every stand-in is derived
by Spark from the given tables, with the same rule written in the oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmarts.sources.seeds import constant_table, load_seed

# ---------------------------------------------------------------------------
# FIXED VALUES: TPC-H nation keys and names (public TPC-H specification).
# ---------------------------------------------------------------------------
TPCH_NATIONS = [
    (0, "ALGERIA"), (1, "ARGENTINA"), (2, "BRAZIL"), (3, "CANADA"), (4, "EGYPT"),
    (5, "ETHIOPIA"), (6, "FRANCE"), (7, "GERMANY"), (8, "INDIA"), (9, "INDONESIA"),
    (10, "IRAN"), (11, "IRAQ"), (12, "JAPAN"), (13, "JORDAN"), (14, "KENYA"),
    (15, "MOROCCO"), (16, "MOZAMBIQUE"), (17, "PERU"), (18, "CHINA"), (19, "ROMANIA"),
    (20, "SAUDI ARABIA"), (21, "VIETNAM"), (22, "RUSSIA"), (23, "UNITED KINGDOM"),
    (24, "UNITED STATES"),
]
# ---------------------------------------------------------------------------


def overrides_for_coded_nations(spark: SparkSession, nations: DataFrame) -> DataFrame:
    """The real override seed, re-keyed onto a nation table whose names are
    codes (``NATION_<key>``): the seed row of the TPC-H nation with the same key."""
    keys = constant_table(spark, TPCH_NATIONS, "nation_key int, tpch_name string")
    seed = load_seed(spark, "nation_region_overrides")
    mapped = keys.join(seed, keys["tpch_name"] == seed["nation_name"]).select(
        "nation_key", "display_name", "sales_region"
    )
    return (
        nations.select("nation_key", "nation_name")
        .join(F.broadcast(mapped), "nation_key")  # at most 25 rows: two constant tables
        .select("nation_name", "display_name", "sales_region")
    )


def part_suppliers_from_line_items(raw_lineitem: DataFrame) -> DataFrame:
    """A raw ``partsupp``-shaped table derived from line items: one row per
    (part, supplier) pair sold, available quantity = total quantity sold,
    supply cost = lowest extended price. Tests the part-dimension logic, not
    real costs."""
    return raw_lineitem.groupBy(
        F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
    ).agg(
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("int").alias("ps_availqty"),
        F.min("l_extendedprice").cast("decimal(12,2)").alias("ps_supplycost"),
    )


def with_local_currency(df: DataFrame, nation_key_col: str = "nation_key", out_col: str = "currency_code") -> DataFrame:
    """A currency code per row derived from its nation key: the fx-seed codes
    in seed order, then an unknown code 'XXX', then NULL (cycle of 13), so
    conversion and the currency check see known, unknown and missing codes."""
    from sparkmarts.sources.seeds import FX_RATES

    codes = [F.lit(c) for c, _, _ in FX_RATES] + [F.lit("XXX"), F.lit(None).cast("string")]
    idx = F.pmod(F.col(nation_key_col), F.lit(len(codes))) + 1
    return df.withColumn(out_col, F.element_at(F.array(*codes), idx.cast("int")))
