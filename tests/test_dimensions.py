import datetime as dt

from helpers import D

from sparkmarts.operators import dimensions


def test_part_without_suppliers(spark):
    parts = spark.createDataFrame(
        [(1, "p1", None, "B", "T", 1, None, D("10.00"), None), (2, "p2", None, "B", "T", 1, None, D("20.00"), None)],
        "part_key bigint, part_name string, manufacturer string, brand string, part_type string, part_size int, "
        "container_type string, retail_price decimal(12,2), part_comment string",
    )
    ps = spark.createDataFrame(
        [(1, 7, 5, D("4.00"), None), (1, 8, 3, D("6.00"), None), (1, 8, 1, D("8.00"), None)],
        "part_key bigint, supplier_key bigint, available_quantity int, supply_cost decimal(12,2), part_supplier_comment string",
    )
    rows = {r.part_key: r for r in dimensions.dim_parts(parts, ps).collect()}
    assert rows[1].supplier_count == 2
    assert rows[1].min_supply_cost == D("4.00") and rows[1].max_supply_cost == D("8.00")
    assert abs(rows[1].avg_supply_cost - 6.0) < 1e-12 and abs(rows[1].avg_margin - 4.0) < 1e-12
    assert rows[1].total_available_quantity == 9
    assert rows[2].supplier_count == 0 and rows[2].total_available_quantity == 0
    assert rows[2].min_supply_cost is None and rows[2].avg_supply_cost is None and rows[2].avg_margin is None


def test_day_of_week_and_business_day(spark):
    df = dimensions.dim_dates(spark, dt.date(2023, 1, 1), dt.date(2023, 1, 3))
    rows = {r.full_date: r for r in df.collect()}
    sun, mon = rows[dt.date(2023, 1, 1)], rows[dt.date(2023, 1, 2)]
    assert (sun.day_of_week, sun.is_business_day) == (0, False)
    assert (mon.day_of_week, mon.is_business_day) == (1, True)
    assert sun.year_month == "2023-01" and sun.month_start == dt.date(2023, 1, 1) and sun.quarter_number == 1


def test_default_spine_is_end_exclusive(spark):
    df = dimensions.dim_dates(spark)
    agg = df.agg({"date_key": "max"}).collect()[0][0]
    assert df.count() == 2922
    assert agg == dt.date(1999, 12, 31)


def test_empty_range(spark):
    assert dimensions.dim_dates(spark, dt.date(2000, 1, 1), dt.date(2000, 1, 1)).count() == 0


def test_pairs_of_a_task_do_not_grow_with_the_table(spark, scratch, monkeypatch):
    from sparkmarts.functions import joins

    path = scratch("partsupp")
    rows = spark.range(20_000).selectExpr(
        "id % 400 AS part_key", "id % 7000 AS supplier_key", "1 AS available_quantity", "CAST(id % 90 AS decimal(12,2)) AS supply_cost"
    )
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    plain = {r.part_key: r for r in dimensions.part_supplier_stats(rows).collect()}
    monkeypatch.setattr(joins, "TASK_BYTES", max(1, joins.leaf_bytes(stored) // 60))
    stats = dimensions.part_supplier_stats(stored)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert {r.part_key: r for r in stats.collect()} == plain
    assert joins.dealt(stored, "part_key").rdd.getNumPartitions() >= 60
    # rows without a known size are left to the planner
    assert "REPARTITION" not in joins.dealt(spark.createDataFrame(rows.limit(5).rdd, rows.schema), "part_key")._jdf.queryExecution().executedPlan().toString()
