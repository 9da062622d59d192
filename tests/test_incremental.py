from helpers import D, d
from pyspark.sql import functions as F

from sparkmarts.operators import incremental
from sparkmarts.plans import loads
from sparkmarts.sources import versions

SCHEMA = "k bigint, v string, order_date date"


def _target(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    incremental.delete_insert(spark, incremental.with_month_partition(df), path, ["k"], ["order_month"])


def test_delete_insert_semantics(spark, scratch):
    path = scratch("di")
    _target(
        spark, path,
        [(1, "old", d("2024-01-05")), (2, "keep", d("2024-01-06")), (3, "alone", d("2024-02-01")),
         (None, "null-old", d("2024-01-07"))],
    )
    batch = spark.createDataFrame(
        [(1, "new", d("2024-01-05")), (4, "dup-a", d("2024-03-01")), (4, "dup-b", d("2024-03-02")),
         (None, "null-new", d("2024-01-08")), (3, "moved", d("2024-03-03"))],
        SCHEMA,
    )
    info = incremental.delete_insert(spark, incremental.with_month_partition(batch), path, ["k"], ["order_month"])
    rows = sorted((r.k if r.k is not None else -1, r.v) for r in incremental.read_fact(spark, path).collect())
    assert rows == sorted([(1, "new"), (2, "keep"), (3, "moved"), (4, "dup-a"), (4, "dup-b"),
                           (-1, "null-old"), (-1, "null-new")])
    assert "order_month=2024-02" not in versions.current(spark, path).parts  # emptied partition removed
    assert ("2024-02",) in info["emptied"]


def test_strict_high_water_mark(spark, scratch):
    path = scratch("hwm")
    _target(spark, path, [(1, "a", d("2024-01-31"))])
    src = spark.createDataFrame([(2, "same-day", d("2024-01-31")), (3, "later", d("2024-02-01"))], SCHEMA)
    batch = incremental.high_water_batch(src, incremental.read_target(spark, path))
    assert [r.k for r in batch.collect()] == [3]


def test_no_target_takes_everything(spark, scratch):
    src = spark.createDataFrame([(2, "x", d("2024-01-31"))], SCHEMA)
    assert incremental.high_water_batch(src, incremental.read_target(spark, scratch("none"))).count() == 1


def test_empty_target_loads_nothing(spark, scratch):
    path = scratch("empty")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    src = spark.createDataFrame([(2, "x", d("2024-01-31"))], SCHEMA)
    assert incremental.high_water_batch(src, incremental.read_target(spark, path)).count() == 0


ITEMS = ("order_key bigint, order_date date, customer_nation string, quantity decimal(12,2), "
         "extended_price decimal(12,2), discounted_price decimal(18,4), net_price decimal(24,6), "
         "discount_percentage decimal(4,2)")


def _item(k, date, nation, price):
    p = D(price)
    return (k, d(date), nation, D("1.00"), p, p, p, D("0.00"))


def test_aggregate_lookback(spark, scratch):
    path = scratch("agg")
    load1 = spark.createDataFrame(
        [_item(1, "2023-11-10", "A", "10.00"), _item(2, "2023-12-10", "A", "20.00"),
         _item(3, "2023-12-11", "B", "5.00"), _item(4, "2024-01-02", "A", "1.00")],
        ITEMS,
    )
    loads.load_revenue_by_nation(spark, load1, path)
    load2 = spark.createDataFrame(
        [_item(1, "2023-11-10", "A", "99.00"),  # older than the look-back: ignored
         _item(2, "2023-12-10", "A", "21.00"),  # recomputed
         _item(4, "2024-01-02", "A", "1.00"), _item(5, "2024-01-20", "A", "2.00")],  # partial month completed
        ITEMS,
    )
    loads.load_revenue_by_nation(spark, load2, path)
    got = {(r.nation_name, r.order_year, r.order_month): (r.order_count, r.gross_revenue)
           for r in versions.read_table(spark, path).collect()}
    assert got[("A", 2023, 11)] == (1, D("10.00"))  # untouched
    assert got[("A", 2023, 12)] == (1, D("21.00"))  # replaced
    assert got[("B", 2023, 12)] == (1, D("5.00"))  # key vanished from the batch: old row stays
    assert got[("A", 2024, 1)] == (2, D("3.00"))  # reloaded
    assert len(got) == 4


def test_two_step_fact_load_equals_full_build(spark, scratch):
    """With no late or moved orders, loading in two steps equals one build."""
    from conftest import SMOKE_DIR

    from sparkmarts.plans.catalog import warehouse

    wh = warehouse(spark, SMOKE_DIR)
    path = scratch("two-step")
    o = wh.orders_enriched
    loads.load_fct_orders(spark, o.where(F.col("order_date") < F.lit("1999-01-01")), wh.line_items, path)
    loads.load_fct_orders(spark, o, wh.line_items, path)
    stored = incremental.read_fact(spark, path)
    full = wh.fct_orders
    assert stored.count() == full.count()
    assert stored.exceptAll(full.select(*stored.columns)).count() == 0


def test_latest_partition_from_listing(spark, scratch):
    from sparkmarts.sources.readers import latest_partition

    path = scratch("latest")
    rows = [(2001, 12, 1), (2001, 9, 2), (2002, 3, 3), (2002, 11, 4), (None, None, 5)]
    spark.createDataFrame(rows, "order_year int, order_month int, v int").write.partitionBy(
        "order_year", "order_month"
    ).parquet(path)
    assert latest_partition(spark, path, ["order_year", "order_month"]) == (2002, 11)
    fact = scratch("latest-fact")
    df = spark.createDataFrame([(1, "x", d("2024-01-31")), (2, "y", d("2024-03-02")), (3, "z", None)], SCHEMA)
    incremental.delete_insert(spark, incremental.with_month_partition(df), fact, ["k"], ["order_month"])
    assert latest_partition(spark, fact, ["order_month"]) == ("2024-03",)
    target = incremental.read_target(spark, fact)
    assert incremental.high_water_mark(target, "order_date", "2024-03") == d("2024-03-02")
    assert latest_partition(spark, scratch("none"), ["order_month"]) is None


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def test_large_loads_go_through_ranges_of_the_key(spark, scratch, monkeypatch):
    from sparkmarts.functions import joins

    def rows(ids, text, month):
        key = F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("k")
        day = F.make_date(F.lit(2024), F.lit(month) + F.col("id").cast("int") % 3, F.lit(5)).alias("order_date")
        # as many rows of one key as of all others: bounds that fall together are one
        made = ids.union(spark.range(300).select(F.lit(7).cast("bigint").alias("id")))
        spread = made.repartition(4, "id").select(key, F.lit(text).alias("v"), day)
        return incremental.with_month_partition(spread)

    def load(path, **options):
        incremental.delete_insert(spark, rows(spark.range(300), "old", 1), path, ["k"], ["order_month"], **options)
        new = rows(spark.range(200, 500), "new", 2)
        if options:
            options["batch_keys"] = new.select("k")
        incremental.delete_insert(spark, new, path, ["k"], ["order_month"], **options)
        return sorted(map(repr, incremental.read_fact(spark, path).collect()))

    whole = load(scratch("whole"))
    written, left = [], []
    real = incremental._write_partitioned
    before = _shuffle_files(spark)

    def watched(df, *a):
        left.append(len(_shuffle_files(spark) - before))
        written.append(df.count())
        real(df, *a)

    monkeypatch.setattr(incremental, "_write_partitioned", watched)
    monkeypatch.setattr(incremental, "SLICE_BYTES", 1000)
    monkeypatch.setattr(incremental, "SLICE_KEYS", 100)
    monkeypatch.setattr(incremental, "leaf_bytes", lambda df: max(joins.leaf_bytes(df), 100_000))
    assert load(scratch("ranges"), batch_keys=rows(spark.range(300), "old", 1).select("k")) == whole
    assert len(written) > 8 and sum(written) >= len(whole) and max(written) < 450
    assert max(left) < 20  # those of one range (its count here), not of all before it


def test_key_slices_take_each_row_once(spark, monkeypatch):
    monkeypatch.setattr(incremental, "SLICE_BYTES", 1)
    monkeypatch.setattr(incremental, "SLICE_KEYS", 10)
    df = spark.createDataFrame([(k if k % 9 else None,) for k in range(-60, 60)] + [(5,)] * 40, "k bigint")
    few = df.where("k between 0 and 30")  # bounds from other keys than the rows'
    for keys in (df, few, df.where("k is null"), df.limit(0)):
        parts = incremental.key_slices(df, "k", keys)
        met = [[r.k for r in df.where(x).collect()] for x in parts]
        assert sorted(map(str, sum(met, []))) == sorted(str(r.k) for r in df.collect())
    assert len(incremental.key_slices(df, "k", df)) > 5
    assert len(incremental.key_slices(df, "k", None)) == 1
    assert len(incremental.key_slices(df.select(F.col("k").cast("string").alias("k")), "k", df.select(F.col("k").cast("string").alias("k")))) == 1
