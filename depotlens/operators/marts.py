"""The four marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.functions.statistics import pearson


def store_daily_metrics(order_items: DataFrame) -> DataFrame:
    """Revenue, distinct orders and units per store and day.

    Items are first reduced per (store, day, invoice), which is also what counts invoices once, so
    a store with a large share of the items is spread over its invoices before it is summed up.
    """
    per_order = order_items.groupBy("store_id", F.col("order_date").alias("metric_date"), "invoice_no").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units")
    )
    return per_order.groupBy("store_id", "metric_date").agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        F.count("invoice_no").alias("orders_count"),
        F.sum("units").alias("units_sold"),
    )


def inventory_analysis(snapshots: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Stock health per store and product; restock days stand in for stockouts, since stock never stays at zero."""
    demand, stock = F.col("avg_daily_demand"), F.col("avg_stock_on_hand")
    averages = snapshots.groupBy("store_id", "stock_code").agg(
        F.avg("units_demanded").alias("avg_daily_demand"),
        F.avg("stock_on_hand").alias("avg_stock_on_hand"),
        F.count_if("restocked").alias("stockout_days"),
    )
    return averages.select(
        "store_id",
        "stock_code",
        "avg_daily_demand",
        "avg_stock_on_hand",
        F.when(demand > 0, F.try_divide(stock, demand)).alias("days_of_supply"),
        "stockout_days",
        F.when(stock > 0, F.try_divide(demand * cfg.days_per_year, stock)).alias("turnover_ratio"),
    )


def store_profitability(daily: DataFrame, stores: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Monthly profit estimate per store. Opex is a full month's also for a partial month."""
    monthly = daily.groupBy("store_id", F.trunc("metric_date", "month").alias("month")).agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue")
    )
    size = stores.select("store_id", F.col("sqft").cast("decimal(10,0)").alias("sqft"))
    revenue = F.col("revenue")
    cogs = revenue * F.lit(cfg.cogs_rate)
    opex = F.col("sqft") * F.lit(cfg.opex_per_sqft)
    costed = monthly.join(size, "store_id").withColumns(
        {"_opex": opex.cast("decimal(14,2)"), "_profit": (revenue - cogs - opex).cast("decimal(24,4)")}
    )
    roi = F.try_divide(F.col("_profit") * F.lit(100).cast("decimal(3,0)"), F.col("_opex"))
    return costed.select(
        "store_id",
        "month",
        "revenue",
        F.round(cogs, 2).cast("decimal(28,2)").alias("cogs_estimate"),
        F.col("_opex").cast("decimal(28,2)").alias("opex_estimate"),
        F.round("_profit", 2).cast("decimal(28,2)").alias("profit_estimate"),
        F.when(F.col("sqft") > 0, F.round(roi, 2)).cast("double").alias("roi_pct"),
    )


def weekly_store_revenue(daily: DataFrame) -> DataFrame:
    monday = F.date_sub("metric_date", F.weekday("metric_date"))
    return daily.groupBy("store_id", monday.alias("week")).agg(F.sum("revenue").cast("double").alias("revenue"))


def cross_store_correlation(daily: DataFrame) -> DataFrame:
    """Correlation of weekly revenue between stores, over the weeks in which both sold.

    Shared seasonality, not evidence that one store takes demand from another. The join sees one
    row per store and week, and store pairs are the result itself.
    """
    weekly = weekly_store_revenue(daily)
    a, b = weekly.alias("a"), weekly.alias("b")
    both = a.join(b, (F.col("a.week") == F.col("b.week")) & (F.col("a.store_id") < F.col("b.store_id")))
    return both.groupBy(F.col("a.store_id").alias("store_id_a"), F.col("b.store_id").alias("store_id_b")).agg(
        pearson(F.col("a.revenue"), F.col("b.revenue")).alias("weekly_revenue_correlation")
    )
