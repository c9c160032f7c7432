"""BI views, measures in a filter and group context, and the dashboard queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.frames import fill_calendar

# -- views ----------------------------------------------------------------------------------------


def _with_store(fact: DataFrame, stores: DataFrame, *columns: str) -> DataFrame:
    """The store dimension is broadcast by its measured size; no hint, so a large one would be shuffled."""
    kept = stores.select("store_id", F.col("name").alias("store_name"), *columns)
    return fact.join(kept, "store_id")


def sales_summary(daily: DataFrame, stores: DataFrame) -> DataFrame:
    average = F.try_divide(F.col("revenue"), F.col("orders_count").cast("decimal(10,0)"))
    return _with_store(daily, stores, "region", "country").select(
        "store_id",
        "store_name",
        "region",
        "country",
        "metric_date",
        "revenue",
        "orders_count",
        "units_sold",
        F.round(average, 2).cast("decimal(28,2)").alias("avg_order_value"),
    )


def inventory_summary(analysis: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    described = products.select("stock_code", "description")
    return (
        _with_store(analysis, stores)
        .join(described, "stock_code", "left")
        .select(
            "store_id",
            "store_name",
            "stock_code",
            "description",
            "avg_daily_demand",
            "avg_stock_on_hand",
            "days_of_supply",
            "stockout_days",
            "turnover_ratio",
        )
    )


def store_performance(profitability: DataFrame, stores: DataFrame) -> DataFrame:
    return _with_store(profitability, stores, "region", "country", "sqft").select(
        "store_id",
        "store_name",
        "region",
        "country",
        "sqft",
        "month",
        "revenue",
        "cogs_estimate",
        "opex_estimate",
        "profit_estimate",
        "roi_pct",
    )


# -- measures -------------------------------------------------------------------------------------


def measure(name: str) -> Column:
    """A named measure as an aggregate; ratios are ratios of sums, averages are unweighted and skip NULLs."""
    revenue, orders = F.sum("revenue"), F.sum("orders_count")
    definitions = {
        "total_revenue": lambda: revenue,
        "total_orders": lambda: orders,
        "avg_order_value": lambda: F.try_divide(revenue.cast("double"), orders.cast("double")),
        "total_profit": lambda: F.sum("profit_estimate"),
        "avg_roi_pct": lambda: F.avg("roi_pct"),
        "avg_turnover_ratio": lambda: F.avg("turnover_ratio"),
        "total_stockout_days": lambda: F.sum("stockout_days"),
        "avg_days_of_supply": lambda: F.avg("days_of_supply"),
    }
    return definitions[name]().alias(name)


def measures(fact: DataFrame, names: Sequence[str], by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Evaluate measures over a view, per group, under a filter."""
    rows = fact if where is None else fact.where(where)
    return rows.groupBy(*by).agg(*(measure(n) for n in names))


def page(fact: DataFrame, visuals: Mapping[str, Sequence[str]], names: Sequence[str], where: Column | None = None) -> DataFrame:
    """All visuals of a page in one pass: (visual, the grouping columns, measures), one row per group of each visual.

    ``visuals`` maps a visual to the columns it groups by, () for a card. The fact is read and shuffled once, as
    grouping sets; a slicer (``where``) holds for the whole page.
    """
    columns = list(dict.fromkeys(c for by in visuals.values() for c in by))
    rows = fact if where is None else fact.where(where)
    # A grouping id has a bit per column, the first column the highest, set where the column is summed over.
    ids = {sum((c not in by) << (len(columns) - 1 - i) for i, c in enumerate(columns)): by for by in visuals.values()}
    if not columns:
        found = rows.agg(*(measure(n) for n in names), F.lit(0).alias("_id"))
    else:
        sets = [[F.col(c) for c in by] for by in ids.values()]
        found = rows.groupingSets(sets, *map(F.col, columns)).agg(*(measure(n) for n in names), F.grouping_id().alias("_id"))
    of = {name: next(i for i, by in ids.items() if set(by) == set(wanted)) for name, wanted in visuals.items()}
    shown = F.array(*(F.struct(F.lit(name).alias("visual"), F.lit(i).alias("id")) for name, i in of.items()))
    shown = F.filter(shown, lambda v: v["id"] == F.col("_id"))
    return found.withColumn("_v", F.explode(shown)).select("_v.visual", *columns, *names)


def slice_stores(fact: DataFrame, stores: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the fact rows of the stores picked by name in the dimension."""
    picked = stores.where(F.col("name").isin(*names)).select("store_id")
    return fact.join(picked, "store_id", "left_semi")


def headline_figures(sales: DataFrame, performance: DataFrame) -> DataFrame:
    """The four cards of the overview as one row."""
    cards = [
        measures(sales, ["total_revenue", "total_orders", "avg_order_value"]),
        measures(performance, ["total_profit"]),
    ]
    (revenue, orders, average), profit = cards[0].columns, cards[1].columns[0]
    return cards[0].select(revenue, orders, average, cards[1].scalar().alias(profit))


# Column titles of the printed reports.
INVENTORY_TITLES = {
    "store_name": "Store",
    "avg_days_of_supply": "Avg days of supply",
    "total_stockout_days": "Total stockout events",
    "avg_turnover_ratio": "Avg turnover ratio (annualized)",
}
PROFIT_TITLES = {
    "store_name": "Store",
    "revenue": "Revenue",
    "cogs_estimate": "COGS (est.)",
    "opex_estimate": "Opex (est.)",
    "profit_estimate": "Profit (est.)",
    "roi_pct": "ROI %",
}
CORRELATION_TITLES = {"store_a": "Store A", "store_b": "Store B", "correlation": "Correlation"}

# -- dashboard ------------------------------------------------------------------------------------


def dashboard_totals(daily: DataFrame, stores: DataFrame, names: Sequence[str]) -> DataFrame:
    """Revenue and orders of the picked stores; the store count ignores the pick."""
    every = stores.agg(F.count("*")).scalar()
    return (
        slice_stores(daily, stores, names)
        .agg(F.sum("revenue").alias("total_revenue"), F.sum("orders_count").alias("total_orders"))
        .select("total_revenue", "total_orders", every.alias("stores"))
    )


def weekly_revenue(daily: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per store and week, labelled by the Sunday that ends it; empty weeks in a store's range are 0."""
    ends = F.date_add("metric_date", 6 - F.weekday("metric_date"))
    weekly = daily.groupBy("store_id", ends.alias("week_end")).agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue")
    )
    filled = fill_calendar(weekly, ["store_id"], "week_end", "revenue", step_days=7)
    return _with_store(filled, stores).select("store_name", "week_end", "revenue")


def inventory_health_by_store(analysis: DataFrame, stores: DataFrame) -> DataFrame:
    return (
        _with_store(analysis, stores)
        .groupBy("store_name")
        .agg(
            F.round(F.avg("days_of_supply"), 1).alias("avg_days_of_supply"),
            F.sum("stockout_days").alias("total_stockout_days"),
            F.round(F.avg("turnover_ratio"), 1).alias("avg_turnover_ratio"),
        )
    )


def worst_stockouts(analysis: DataFrame, stores: DataFrame, n: int = 10) -> DataFrame:
    # Sorted last: a join behind the limit may stream either side and lose the order.
    named = _with_store(analysis, stores).orderBy(F.desc("stockout_days"), "store_id", "stock_code").limit(n)
    return named.select("store_name", "stock_code", "stockout_days")


def profit_months(profitability: DataFrame) -> DataFrame:
    """The months on offer, latest first."""
    return profitability.select("month").distinct().orderBy(F.desc("month"))


def profit_ranking(
    profitability: DataFrame, stores: DataFrame, month: date | None = None
) -> DataFrame:
    """Stores by profit in one month, the latest unless given."""
    chosen = F.lit(month) if month else profitability.agg(F.max("month")).scalar()
    return (
        _with_store(profitability.where(F.col("month") == chosen), stores)
        .select("store_name", "month", "revenue", "cogs_estimate", "opex_estimate", "profit_estimate", "roi_pct")
        .orderBy(F.desc("profit_estimate"), "store_name")
    )


def correlation_listing(correlation: DataFrame, stores: DataFrame) -> DataFrame:
    """Correlations under store names, three decimals; the store table plays both roles."""

    def named(side: str) -> DataFrame:
        return stores.select(F.col("store_id").alias(f"store_id_{side}"), F.col("name").alias(f"store_{side}"))

    return (
        correlation.join(named("a"), "store_id_a")
        .join(named("b"), "store_id_b")
        .select("store_a", "store_b", F.round("weekly_revenue_correlation", 3).alias("correlation"))
    )


def relabel(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """The labelled columns in label order, under their report titles."""
    return df.select(*(F.col(name).alias(title) for name, title in labels.items()))


def store_locations(stores: DataFrame) -> DataFrame:
    return stores.select("name", "region", "country", "lat", "lon").orderBy("name")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), column)
