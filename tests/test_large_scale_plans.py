"""The plans used at scale (no dimension fits a broadcast) give the same rows
as the small-data plans."""

import dataclasses

import pytest
from conftest import SMOKE_DIR

from sparkmarts.functions import joins
from sparkmarts.operators import reports
from sparkmarts.plans.warehouse import Warehouse


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "DEFAULT_SETTINGS", dataclasses.replace(joins.DEFAULT_SETTINGS, reference_max_bytes=-1))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _marts(wh):
    return {
        "fct_orders": wh.fct_orders,
        "fct_order_items": wh.fct_order_items,
        "revenue_by_nation": wh.revenue_by_nation,
        "dim_customers": wh.dim_customers,
        "supplier_concentration": reports.supplier_concentration(wh.order_lines),
    }


def test_sort_merge_plans_match(spark, no_broadcast):
    big = _marts(Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True))
    plan = big["fct_order_items"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    rows = {k: sorted(map(repr, v.collect())) for k, v in big.items()}
    joins.DEFAULT_SETTINGS = dataclasses.replace(joins.DEFAULT_SETTINGS, reference_max_bytes=1 << 20)
    for k in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]:
        spark.conf.unset(k)
    small = _marts(Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True))
    assert "BroadcastHashJoin" in small["fct_order_items"]._jdf.queryExecution().executedPlan().toString()
    for k, v in small.items():
        assert sorted(map(repr, v.collect())) == rows[k], k


def test_new_orders_cut_the_lines_before_the_part_join(spark, no_broadcast):
    from sparkmarts.operators import facts
    from sparkmarts.plans import loads

    wh = Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True)
    new = wh.enrich_orders(wh.orders.where("order_date >= '2001-06-01'"))
    batch = facts.fct_order_items(wh.enrich_line_items(loads._lines_of(wh.line_items, new, True)), new)
    plan = batch._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    left_joins = [i for i, x in enumerate(lines) if "LeftOuter" in x and i < semi]
    assert any(depth(lines[i]) < depth(lines[semi]) for i in left_joins)  # it stands below a dimension join
    full = wh.fct_order_items.where("order_date >= '2001-06-01'")
    assert batch.exceptAll(full).count() == 0 and full.exceptAll(batch).count() == 0


def test_no_job_starts_while_plans_are_built(spark):
    wh = Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True)
    for t in ("customers", "orders", "line_items", "parts", "suppliers", "nations", "regions"):
        getattr(wh, t)  # Spark reads the files' footers for their schema
    wh.part_suppliers
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        for name, df in _marts(wh).items():
            df._jdf.queryExecution().executedPlan()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rollup_aggregates_before_its_shuffle(spark):
    wh = Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True)
    plan = wh.order_rollup._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(order_key" in x)
    assert any("partial_" in x for x in lines[exchange:]) and "REPARTITION" not in plan


def test_prices_are_not_carried_through_the_joins(spark, no_broadcast):
    wh = Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True)
    plan = wh.line_items_enriched._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first_join = next(i for i, x in enumerate(plan) if "Join LeftOuter" in x)
    assert not any("AS discounted_price" in x or "AS net_price" in x for x in plan[first_join:])
    assert any("AS net_price" in x for x in plan[:first_join])


def test_suppliers_are_broadcast_up_to_a_bound(spark, monkeypatch):
    size = joins.leaf_bytes(Warehouse(spark, SMOKE_DIR, fill_missing=True).suppliers)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, hinted in ((size, True), (size // 64, False)):
            monkeypatch.setattr(joins, "DEFAULT_SETTINGS", dataclasses.replace(joins.DEFAULT_SETTINGS, reference_max_bytes=bound))
            wh = Warehouse(spark, SMOKE_DIR, fill_missing=True)
            plan = wh.line_items_enriched._jdf.queryExecution().optimizedPlan().toString()
            assert ("supplier_key" in plan) and ("rightHint=(strategy=broadcast)" in next(x for x in plan.split("\n") if "Join LeftOuter" in x)) == hinted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["order_items", "returns"])
def test_loads_join_lines_to_their_orders_once_and_first(spark, no_broadcast, monkeypatch, name):
    from sparkmarts.plans import loads

    wh = Warehouse(spark, SMOKE_DIR, fill_missing=True, coded_nation_names=True)
    new = wh.orders.where("order_date >= '2001-06-01'")
    made = []
    monkeypatch.setattr(loads, "delete_insert", lambda spark, batch, *a, **k: made.append(batch))
    for some in (False, True):
        getattr(loads, f"store_fct_{name}")(spark, wh.enrich_orders(new), wh.line_items, "unused", some, wh.enrich_line_items)
    full = getattr(wh, f"fct_{name}").where("order_date >= '2001-06-01'")
    for batch in (x.drop("order_month") for x in made):
        plan = batch._jdf.queryExecution().optimizedPlan().toString().split("\n")
        joins_of = [x for x in plan if "Join " in x]
        assert "(part_key" in joins_of[1] and "Join Inner, (order_key" in joins_of[2]  # suppliers, then parts stand above
        assert not any("LeftSemi" in x for x in joins_of)
        assert batch.exceptAll(full).count() == 0 and full.exceptAll(batch).count() == 0
