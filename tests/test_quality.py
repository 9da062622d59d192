from helpers import D
from pyspark.sql import functions as F

from sparkmarts.operators import quality


def test_checks_and_report(spark):
    df = spark.createDataFrame(
        [(1, "a", D("1.00")), (1, "b", D("-1.00")), (None, "c", D("2.00")), (None, None, D("3.00"))],
        "k int, s string, x decimal(12,2)",
    )
    parent = spark.createDataFrame([(1,)], "k int")
    assert quality.unique_failures(df, "k").collect()[0].n_records == 2  # NULLs ignored
    assert quality.not_null_failures(df, "k").count() == 2
    assert quality.not_negative_failures(df, "x").count() == 1
    assert {r.s for r in quality.accepted_values_failures(df, "s", ["a"]).collect()} == {"b", "c"}  # NULL not reported
    assert quality.relationships_failures(df, "k", parent, "k").count() == 0  # NULL child keys pass
    suite = (quality.CheckSuite()
             .add("unique", "t", "k").add("not_null", "t", ["k", "s"])
             .add("not_negative", "t", "x", severity="error")
             .add("accepted_values", "t", "s", values=("a", "b", "c"))
             .add("relationships", "t", "k", parent="p", parent_column="k"))
    rep = {r.check_name: (r.failures, r.status) for r in quality.run_checks(spark, {"t": df, "p": parent}, suite.checks).collect()}
    assert rep == {
        "unique:t.k": (1, "warn"),
        "not_null:t.k": (2, "warn"),
        "not_null:t.s": (1, "warn"),
        "not_negative:t.x": (1, "error"),
        "accepted_values:t.s": (0, "pass"),
        "relationships:t.k": (0, "pass"),
    }


def test_months_complete(spark):
    rows = [("A", 2020, m) for m in range(1, 13)] + [("A", 2021, m) for m in range(1, 4)] + [("B", 2020, 5)]
    rows += [("A", 2022, 1)]
    df = spark.createDataFrame(rows, "nation_name string, order_year int, order_month int")
    got = {(r.nation_name, r.order_year, r.month_count) for r in quality.months_complete_failures(df).collect()}
    assert got == {("A", 2021, 3), ("B", 2020, 1)}


def test_store_failures(spark, scratch):
    df = spark.createDataFrame([(None,), (1,)], "k int")
    path = scratch("failures")
    quality.run_checks(spark, {"t": df}, quality.CheckSuite().add("not_null", "t", "k").checks, store_failures_to=path)
    assert spark.read.parquet(path + "/not_null_t.k").count() == 1


def test_watched_checks_need_no_scan_of_their_own(spark, scratch):
    rows = [(1, "a", 1.0), (2, None, -1.0), (None, None, -2.0), (4, "d", None)]
    df = spark.createDataFrame(rows, "k int, v string, x double")
    s = quality.CheckSuite().add("not_null", "view", ["k", "v"]).add("not_negative", "mart", "x").add("unique", "mart", "k")
    watch = quality.Watch(s.checks)
    mart = watch.on("mart", watch.on("view", df).where("k is not null or v is null"), written=True)
    assert watch.on("other", df) is df
    mart.write.parquet(path := scratch("mart"))
    got = watch.failures()
    # a count inside the job stands only if it is zero
    assert {c.name: n for c, n in got.items()} == {"not_negative:mart.x": 2}
    stored = {"view": df, "mart": spark.read.parquet(path)}
    report = {r.check_name: (r.failures, r.status) for r in quality.run_checks(spark, stored, s.checks, counted=got).collect()}
    plain = {r.check_name: (r.failures, r.status) for r in quality.run_checks(spark, stored, s.checks).collect()}
    assert report == plain == {
        "not_null:view.k": (1, "warn"), "not_null:view.v": (2, "warn"), "not_negative:mart.x": (2, "warn"), "unique:mart.k": (0, "pass")
    }


def test_report_is_computed_on_the_marts_it_names(spark, scratch):
    """A repeated part key multiplies the real mart's lines: its key check must see it."""
    from conftest import SMOKE_DIR

    from sparkmarts.plans import catalog
    from sparkmarts.sources.sinks import save_table

    root = scratch("dup")
    for t in ("nation", "region", "customer", "orders", "supplier", "part", "lineitem"):
        df = spark.read.parquet(f"{SMOKE_DIR}/{t}.parquet")
        if t == "lineitem":  # (order, line) pairs that occur once
            df = df.dropDuplicates(["l_orderkey", "l_linenumber"])
        save_table(df, f"{root}/{t}.parquet")
    name = "unique:fct_order_items.order_item_key"
    report = lambda: {r.check_name: r.failures for r in catalog.dq_report(catalog.warehouse(spark, root).fresh()).collect()}
    before = report()
    assert before[name] == 0 and before["unique:stg_parts.part_key"] == 0
    parts = spark.read.parquet(f"{SMOKE_DIR}/part.parquet")
    sold = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    again = parts.where(F.col("p_partkey") == sold.agg(F.min("p_partkey")).first()[0])
    save_table(parts.unionByName(again), f"{root}/part.parquet")
    after = report()
    assert after[name] > 0 and after["unique:stg_parts.part_key"] == 1
    assert before.keys() == after.keys()
