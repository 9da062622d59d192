"""Dimensions: customers, suppliers, parts, dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmarts.functions.columns import day_of_week_sun0, month_start, ratio
from sparkmarts.functions.joins import dealt
from sparkmarts.operators.enrich import with_geography, with_segment_label
from sparkmarts.settings import DEFAULT_SETTINGS

DIM_PARTS_COLUMNS = [
    "part_key", "part_name", "manufacturer", "brand", "part_type", "part_size",
    "container_type", "retail_price", "supplier_count", "min_supply_cost",
    "avg_supply_cost", "max_supply_cost", "total_available_quantity", "avg_margin",
]


def dim_customers(customers: DataFrame, geography: DataFrame, labels: DataFrame) -> DataFrame:
    df = with_segment_label(with_geography(customers, geography), labels)
    return df.select(
        "customer_key", "customer_name", "customer_address", "phone_number",
        "account_balance", "market_segment", "market_segment_label",
        "nation_name", "region_name", "sales_region",
    )


def dim_suppliers(suppliers: DataFrame, geography: DataFrame) -> DataFrame:
    return with_geography(suppliers, geography).select(
        "supplier_key", "supplier_name", "supplier_address", "phone_number",
        "account_balance", "nation_name", "region_name", "sales_region",
    )


def part_supplier_stats(part_suppliers: DataFrame) -> DataFrame:
    """Per-part supplier statistics.

    Two-level aggregation instead of a ``count(distinct)`` next to other
    aggregates: first per (part, supplier), then per part. Both levels use
    partial aggregation, and averages are carried as sum and count. Nearly every
    row is a pair of its own, so a task holds its pairs whole: their number is bounded
    by dealing the rows to as many tasks as their tables' size asks for."""
    per_pair = dealt(part_suppliers, "part_key", "supplier_key").groupBy("part_key", "supplier_key").agg(
        F.min("supply_cost").alias("_min"),
        F.max("supply_cost").alias("_max"),
        F.sum("supply_cost").alias("_sum"),
        F.count("supply_cost").alias("_cnt"),
        F.sum("available_quantity").alias("_qty"),
    )
    return per_pair.groupBy("part_key").agg(
        F.count("supplier_key").alias("supplier_count"),
        F.min("_min").alias("min_supply_cost"),
        ratio(F.sum("_sum"), F.sum("_cnt")).alias("avg_supply_cost"),
        F.max("_max").alias("max_supply_cost"),
        F.sum("_qty").alias("total_available_quantity"),
    )


def dim_parts(parts: DataFrame, part_suppliers: DataFrame) -> DataFrame:
    """Parts LEFT per-part supplier stats. Counts default to 0; costs and the
    margin stay NULL for parts without suppliers."""
    stats = part_supplier_stats(part_suppliers)
    return (
        parts.join(stats, "part_key", "left")
        .withColumn("supplier_count", F.coalesce("supplier_count", F.lit(0).cast("bigint")))
        .withColumn(
            "total_available_quantity",
            F.coalesce("total_available_quantity", F.lit(0).cast("bigint")),
        )
        .withColumn("avg_margin", F.col("retail_price").cast("double") - F.col("avg_supply_cost"))
        .select(*DIM_PARTS_COLUMNS)
    )


def _as_date_col(v: dt.date | str | Column) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    return F.lit(str(v)).cast("date")


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end). ``start``/``end`` may be dates or
    Columns of a one-row DataFrame (use :func:`date_spine_over`)."""
    one = spark.range(1)
    return _spine(one, _as_date_col(start), _as_date_col(end))


def _spine(one_row: DataFrame, start: Column, end: Column) -> DataFrame:
    days = F.sequence(start, F.date_sub(end, 1), F.expr("interval 1 day"))
    return one_row.select(
        F.explode(F.when(end > start, days).otherwise(F.array().cast("array<date>"))).alias("date_day")
    )


def dim_dates(spark: SparkSession, start=None, end=None) -> DataFrame:
    """Day dimension over the end-exclusive range (defaults from settings)."""
    start = DEFAULT_SETTINGS.date_spine_start if start is None else start
    end = DEFAULT_SETTINGS.date_spine_end if end is None else end
    return date_attributes(date_spine(spark, start, end))


def dim_dates_for_range(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Day dimension whose range comes from a one-row DataFrame (e.g. the
    min/max of a fact's dates, computed by Spark)."""
    return date_attributes(_spine(bounds, F.col(start_col).cast("date"), F.col(end_col).cast("date")))


def date_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    dow = day_of_week_sun0(d)
    return spine.select(
        d.alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        (~dow.isin(0, 6)).alias("is_business_day"),
        month_start(d).alias("month_start"),
    )
