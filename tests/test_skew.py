"""A third of the line items on one order key, a third of the orders on one
customer: results stay whole and AQE splits the hot partitions of the
sort-merge joins (thresholds lowered so the split happens at test size)."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from sparkmarts.functions import joins
from sparkmarts.plans.warehouse import Warehouse
from sparkmarts.sources.landing import land_tables

SRC = "/root/testdata/sf0.01"
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture()
def skewed_root(spark, scratch, monkeypatch):
    monkeypatch.setattr(joins, "DEFAULT_SETTINGS", dataclasses.replace(joins.DEFAULT_SETTINGS, reference_max_bytes=-1))
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    root = scratch("skew")
    land_tables(spark, SRC, root, ["customer", "supplier", "part", "nation", "region"])
    orders = spark.read.parquet(f"{SRC}/orders.parquet")
    hot_customer = orders.agg(F.min("o_custkey")).first()[0]
    orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot_customer)).otherwise(F.col("o_custkey"))
    ).repartition(8).write.parquet(f"{root}/orders.parquet")
    li = spark.read.parquet(f"{SRC}/lineitem.parquet")
    hot = li.agg(F.min("l_orderkey")).first()[0]
    third = F.pmod(F.xxhash64("l_partkey", "l_linenumber", "l_suppkey"), F.lit(3)) == 0
    li.withColumn("l_orderkey", F.when(third, F.lit(hot)).otherwise(F.col("l_orderkey"))).repartition(8).write.parquet(
        f"{root}/lineitem.parquet"
    )
    yield root, hot
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_order_key(spark, skewed_root):
    root, hot = skewed_root
    wh = Warehouse(spark, root, fill_missing=True, coded_nation_names=True)
    items = wh.fct_order_items
    rows = items.collect()
    assert "SortMergeJoin(skew=true)" in items._jdf.queryExecution().executedPlan().toString()
    narrow = wh.order_lines
    narrow.collect()
    assert "SortMergeJoin(skew=true)" in narrow._jdf.queryExecution().executedPlan().toString()
    li = spark.read.parquet(f"{root}/lineitem.parquet")
    assert len(rows) == li.count()
    assert sum(1 for r in rows if r.order_key == hot) > len(rows) // 4
    # the per-order rollup absorbs the hot key by partial aggregation
    fo = wh.fct_orders.where(F.col("order_key") == hot).collect()[0]
    assert fo.line_item_count == sum(1 for r in rows if r.order_key == hot)
    total = wh.revenue_by_nation.agg(F.sum("net_revenue")).first()[0]
    assert total == sum(r.discounted_price for r in rows)


def test_hot_customer(spark, skewed_root):
    root, _ = skewed_root
    wh = Warehouse(spark, root, fill_missing=True, coded_nation_names=True)
    oe = wh.orders_enriched
    rows = oe.collect()
    plan = oe._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan  # orders LEFT JOIN customers, hot side split
    assert len(rows) == spark.read.parquet(f"{root}/orders.parquet").count()
    assert all(r.customer_name is not None for r in rows)
