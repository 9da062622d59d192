import pytest
from helpers import D

from sparkmarts.operators import dimensions, enrich, staging
from sparkmarts.sources.seeds import load_seed

CUST = ("customer_key bigint, customer_name string, customer_address string, nation_key int, "
        "phone_number string, account_balance decimal(12,2), market_segment string, customer_comment string")


def _geo(spark):
    nations = spark.createDataFrame(
        [(6, "FRANCE", 3, None), (99, "ATLANTIS", 3, None)], "nation_key int, nation_name string, region_key int, nation_comment string"
    )
    regions = spark.createDataFrame([(3, "EUROPE", None)], "region_key int, region_name string, region_comment string")
    return enrich.nation_geography(nations, regions, load_seed(spark, "nation_region_overrides"))


def test_geography_override_and_fallbacks(spark):
    geo = _geo(spark)
    cust = spark.createDataFrame(
        [
            (1, "a", None, 6, None, D("1.00"), "AUTOMOBILE", None),
            (2, "b", None, 99, None, D("1.00"), "AUTOMOBILE", None),
            (3, "c", None, None, None, D("1.00"), "AUTOMOBILE", None),
        ],
        CUST,
    )
    rows = {r.customer_key: r for r in dimensions.dim_customers(cust, geo, load_seed(spark, "market_segment_labels")).collect()}
    assert (rows[1].nation_name, rows[1].region_name, rows[1].sales_region) == ("FRANCE", "EUROPE", "EMEA")
    assert rows[2].sales_region == "EUROPE"  # nation not in the seed: region name
    assert rows[3].sales_region is None and rows[3].nation_name is None  # no nation
    assert rows[1].market_segment_label == "Automobile"


def test_segment_label_fallback(spark):
    df = spark.createDataFrame([(1, "OTHER"), (2, None), (3, "MACHINERY")], "k int, market_segment string")
    out = {r.k: r.market_segment_label for r in enrich.with_segment_label(df, load_seed(spark, "market_segment_labels")).collect()}
    assert out == {1: "OTHER", 2: None, 3: "Heavy Machinery"}


def test_segment_label_duplicates_raise(spark):
    labels = spark.createDataFrame(
        [("A", "x", "g", 1), ("A", "y", "g", 1)], "market_segment string, display_label string, industry_group string, priority_tier int"
    )
    df = spark.createDataFrame([(1, "A")], "k int, market_segment string")
    with pytest.raises(Exception, match="more than one label for A"):
        enrich.with_segment_label(df, labels).collect()


def test_priced_line_items_exact(spark):
    li = spark.createDataFrame(
        [(D("100.00"), D("0.10"), D("0.05"))], "extended_price decimal(12,2), discount_percentage decimal(4,2), tax_rate decimal(4,2)"
    )
    r = enrich.priced_line_items(li).collect()[0]
    assert r.discounted_price == D("90.0000") and r.net_price == D("94.500000")


def test_staging_strict_and_fill_missing(spark):
    raw = spark.createDataFrame([(1, "r")], "r_regionkey int, r_name string")
    with pytest.raises(staging.MissingSourceColumn):
        staging.stage(raw, "region")
    out = staging.stage(raw, "region", fill_missing=True)
    assert out.columns == ["region_key", "region_name", "region_comment"]
    assert dict(out.dtypes)["region_comment"] == "string"
    assert out.collect()[0].region_comment is None


def test_strict_warehouse_refuses_partial_extracts(spark):
    from conftest import SMOKE_DIR

    from sparkmarts.plans.warehouse import Warehouse

    wh = Warehouse(spark, SMOKE_DIR)  # strict by default
    with pytest.raises(staging.MissingSourceColumn):
        wh.customers  # no address, phone or comment columns in the extract
    with pytest.raises(Exception):
        wh.part_suppliers.collect()  # no partsupp table and no stand-in when strict
    assert Warehouse(spark, SMOKE_DIR, fill_missing=True).part_suppliers.count() > 0


def test_money_is_never_rounded(spark):
    raw = lambda v: spark.createDataFrame([(1, v)], "c_custkey long, c_acctbal double")
    stage = lambda v: staging.stage(raw(v), "customer", fill_missing=True).first().account_balance
    assert stage(1234567.89) == D("1234567.89") and stage(None) is None and stage(-0.07) == D("-0.07")
    with pytest.raises(Exception, match="no exact decimal"):
        stage(0.0825)
