import datetime as dt

import pytest
from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from sparkmarts.sources import landing
from sparkmarts.sources.seeds import load_seed
from sparkmarts.sources.versions import read_table


def test_land_create_skip_replace(spark, scratch):
    dst = scratch("land")
    assert landing.land_tables(spark, SMOKE_DIR, dst, ["nation", "region"]) == [("nation", "created"), ("region", "created")]
    assert landing.land_tables(spark, SMOKE_DIR, dst, ["nation"]) == [("nation", "skipped")]
    assert landing.land_tables(spark, SMOKE_DIR, dst, ["nation"], full_refresh=True) == [("nation", "replaced")]
    assert read_table(spark, dst + "/nation.parquet").count() == 25
    with pytest.raises(ValueError):
        landing.land_tables(spark, SMOKE_DIR, dst, [])


def test_reload_methods(spark, scratch):
    dst = scratch("reload")
    landing.land_tables(spark, SMOKE_DIR, dst, ["region"])
    for m in landing.RELOAD_METHODS:
        landing.reload_table(spark, SMOKE_DIR, dst, ["region"], m)
        assert read_table(spark, dst + "/region.parquet").count() == 5
    with pytest.raises(ValueError):
        landing.reload_table(spark, SMOKE_DIR, dst, ["region"], "bogus")
    with pytest.raises(ValueError):
        landing.reload_table(spark, SMOKE_DIR, dst, [], "recreate")


def test_next_keys_gap_free_and_ordered(spark):
    batch = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 3 % 1000).alias("src"))
    keyed = landing.assign_next_keys(spark, batch, "k", 41, order_by=["src"]).collect()
    keys = sorted(r.k for r in keyed)
    assert keys == list(range(42, 1042))
    by_src = sorted(keyed, key=lambda r: r.src)
    assert [r.k for r in by_src] == keys


def test_append_rejects_empty_batch(spark, scratch):
    empty = spark.createDataFrame([], "o_orderkey bigint")
    with pytest.raises(ValueError):
        landing.append_with_next_keys(spark, scratch("t"), empty, "o_orderkey", dt.datetime(2024, 1, 1))


def test_seeds(spark):
    assert load_seed(spark, "nation_region_overrides").count() == 25
    fx = load_seed(spark, "fx_rates")
    assert fx.count() == 11 and dict(fx.dtypes)["usd_rate"] == "decimal(12,6)"
    labels = load_seed(spark, "market_segment_labels")
    assert labels.count() == 5 and dict(labels.dtypes)["priority_tier"] == "int"
    regions = {r.sales_region: r[1] for r in load_seed(spark, "nation_region_overrides").groupBy("sales_region").count().collect()}
    assert regions == {"NORTH AMERICA": 2, "LATAM": 3, "APAC": 5, "EMEA": 15}
