"""Analyst reports over the marts: month-over-month trend, supplier
concentration, top customers, returns alert, supplier scorecard, currency
conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmarts.functions.columns import ratio
from sparkmarts.functions.joins import broadcast_reference
from sparkmarts.session import work_dir


def monthly_revenue_trend(agg_by_sales_region: DataFrame) -> DataFrame:
    """Net revenue per sales region and month with the previous row's value,
    the delta and the relative change (NULL when the previous is NULL or 0).

    ``lag`` steps over rows, not calendar months: a region with a missing
    month compares with the previous month it has. The window runs on the
    monthly aggregate (regions x months rows), never on line-level data."""
    w = Window.partitionBy("sales_region").orderBy("order_year", "order_month")
    prev = F.lag("net_revenue").over(w)
    return (
        agg_by_sales_region.select("sales_region", "order_year", "order_month", "net_revenue")
        .withColumn("prev_month_net_revenue", prev)
        .withColumn("mom_delta", F.col("net_revenue") - F.col("prev_month_net_revenue"))
        .withColumn("mom_pct_change", ratio("mom_delta", "prev_month_net_revenue"))
        .orderBy("sales_region", "order_year", "order_month")
    )


def supplier_concentration(order_items: DataFrame, top_n: int = 5, buckets: int = 64) -> DataFrame:
    """Share of each sales region's net revenue earned by its top ``top_n``
    suppliers (ties broken by supplier key).

    Revenue per (region, supplier) is a partial aggregation. The top-n is
    found in two exact steps so no task ever holds a whole region: a ranking
    within (region, hash bucket of supplier) keeps each bucket's top-n (the
    region's top-n are always among them), then a ranking of those
    candidates per region. Spark also places a partial ``WindowGroupLimit``
    before each ranking shuffle, so only the top-n rows per map task and
    group are shuffled. Region totals come from a plain aggregation."""
    rev = order_items.groupBy("sales_region", "supplier_key").agg(
        F.sum("discounted_price").alias("net_revenue")
    )
    order = [F.col("net_revenue").desc_nulls_last(), F.col("supplier_key").asc_nulls_last()]
    bucket = F.pmod(F.xxhash64("supplier_key"), F.lit(buckets))
    local = (
        rev.withColumn("_bucket", bucket)
        .withColumn("_r", F.row_number().over(Window.partitionBy("sales_region", "_bucket").orderBy(*order)))
        .where(F.col("_r") <= top_n)
        .drop("_r", "_bucket")
    )
    ranked = local.withColumn("supplier_rank", F.row_number().over(Window.partitionBy("sales_region").orderBy(*order)))
    top = ranked.where(F.col("supplier_rank") <= top_n).groupBy(F.col("sales_region").alias("_top_region")).agg(
        F.sum("net_revenue").alias("top_5_net_revenue")
    )
    totals = rev.groupBy("sales_region").agg(F.sum("net_revenue").alias("region_net_revenue"))
    return (
        totals.join(top, F.col("sales_region").eqNullSafe(F.col("_top_region")), "left")
        .select(
            "sales_region",
            F.coalesce("top_5_net_revenue", F.lit(0).cast("decimal(38,4)")).alias("top_5_net_revenue"),
            "region_net_revenue",
        )
        .withColumn("top_5_share", ratio("top_5_net_revenue", "region_net_revenue"))
        .orderBy(F.col("top_5_share").desc_nulls_last(), "sales_region")
    )


def top_customers(fct_orders: DataFrame, dim_customers: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` customers with the highest lifetime net revenue (NULLs last,
    ties by customer key). ``orderBy().limit()`` plans a TakeOrderedAndProject:
    each task keeps its local top-k, only k rows per task reach the final merge."""
    rev = fct_orders.groupBy("customer_key").agg(
        F.sum("net_revenue").alias("lifetime_net_revenue"), F.count(F.lit(1)).alias("order_count")
    )
    dim = dim_customers.select("customer_key", "customer_name", "market_segment_label", "nation_name", "sales_region")
    return (
        rev.join(dim, "customer_key", "inner")
        .select(
            "customer_key", "customer_name", "market_segment_label", "nation_name", "sales_region",
            "order_count", "lifetime_net_revenue",
        )
        .orderBy(F.col("lifetime_net_revenue").desc_nulls_last(), F.col("customer_key").asc())
        .limit(k)
    )


def returns_alert(
    fct_returns: DataFrame,
    date_col: str = "return_receipt_date",
    amount_col: str = "returned_net_amount",
    window_days: int = 14,
    threshold: float = 1.25,
) -> DataFrame:
    """Days whose returned amount exceeds ``threshold`` x the average of the
    previous ``window_days`` calendar days (days without returns count as 0).

    One row per day with returns: return_date, returned_amount, trailing_avg
    (NULL until ``window_days`` days of history exist), is_alert. The trailing
    sums are computed without a global window: each daily total is sent to the
    ``window_days`` following days and summed per target day (a fixed,
    small fan-out of an already aggregated table), so the work stays
    distributed and no calendar needs to be materialized."""
    daily = (
        fct_returns.where(F.col(date_col).isNotNull())
        .groupBy(F.col(date_col).cast("date").alias("return_date"))
        .agg(F.sum(amount_col).alias("returned_amount"))
    )
    # One row per day, used three times (totals, fan-out, first day): written
    # once to the shared checkpoint folder so the returns pipeline runs once
    # (the optimizer would otherwise compute the first day from the source).
    work_dir(daily.sparkSession)
    daily = daily.checkpoint(eager=True)
    first_day = daily.agg(F.min("return_date")).scalar()  # uncorrelated scalar subquery
    shifted = daily.select(
        F.explode(F.sequence(F.lit(1), F.lit(window_days))).alias("_lag"), "return_date", "returned_amount"
    ).select(F.date_add("return_date", F.col("_lag")).alias("return_date"), F.col("returned_amount").alias("_prior"))
    prior = shifted.groupBy("return_date").agg(F.sum("_prior").alias("_prior_sum"))
    d = (
        daily.join(prior, "return_date", "left")
        .withColumn("_has_history", F.col("return_date") >= F.date_add(first_day, window_days))
        .withColumn("_prior_sum", F.coalesce("_prior_sum", F.lit(0)))
    )
    trailing = F.when(F.col("_has_history"), F.col("_prior_sum").cast("double") / F.lit(float(window_days)))
    # exact decimal test: amount > threshold * prior_sum / window  <=>  amount * window > threshold * prior_sum
    exceeds = F.col("returned_amount") * F.lit(window_days) > F.lit(threshold).cast("decimal(10,4)") * F.col("_prior_sum")
    return d.select(
        "return_date",
        "returned_amount",
        trailing.alias("trailing_avg"),
        (F.col("_has_history") & exceeds).alias("is_alert"),
    )


def supplier_scorecard(
    dim_suppliers: DataFrame, order_items: DataFrame, returns: DataFrame | None = None
) -> DataFrame:
    """Supplier dimension with sold and returned volumes and the return rate
    (returned net amount / net revenue, NULL when there is no revenue).

    ``returns`` is the returns fact; without it the returned volumes come from
    the order lines' return flag in the same aggregation (one pass over the
    lines instead of two)."""
    if returns is None:
        returned = F.col("return_flag") == "R"
        stats = order_items.groupBy("supplier_key").agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("extended_price").alias("gross_revenue"),
            F.sum("discounted_price").alias("net_revenue"),
            F.count_if(returned).alias("returned_line_count"),
            F.sum(F.when(returned, F.col("quantity"))).alias("returned_quantity"),
            F.sum(F.when(returned, F.col("discounted_price"))).alias("returned_net_amount"),
        )
    else:
        sold = order_items.groupBy("supplier_key").agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("extended_price").alias("gross_revenue"),
            F.sum("discounted_price").alias("net_revenue"),
        )
        back = returns.groupBy("supplier_key").agg(
            F.count(F.lit(1)).alias("returned_line_count"),
            F.sum("returned_quantity").alias("returned_quantity"),
            F.sum("returned_net_amount").alias("returned_net_amount"),
        )
        stats = sold.join(back, "supplier_key", "full_outer")
    return (
        dim_suppliers.select("supplier_key", "supplier_name", "nation_name", "region_name", "sales_region", "account_balance")
        .join(stats, "supplier_key", "left")
        .withColumn("line_count", F.coalesce("line_count", F.lit(0).cast("bigint")))
        .withColumn("returned_line_count", F.coalesce("returned_line_count", F.lit(0).cast("bigint")))
        .withColumn("return_rate", ratio("returned_net_amount", "net_revenue"))
    )


def convert_to_usd(
    df: DataFrame,
    amount_col: str,
    currency_col: str,
    fx_rates: DataFrame,
    out_col: str | None = None,
) -> DataFrame:
    """``amount * usd_rate`` of the row's currency (a broadcast lookup
    while the rates are proven small); unknown or NULL codes give NULL."""
    out_col = out_col or f"{amount_col}_usd"
    fx = broadcast_reference(
        fx_rates.select(F.col("currency_code").alias("_fx_code"), F.col("usd_rate").alias("_fx_rate"))
    )
    return (
        df.join(fx, df[currency_col] == fx["_fx_code"], "left")
        .withColumn(out_col, F.col(amount_col) * F.col("_fx_rate"))
        .drop("_fx_code", "_fx_rate")
    )
