from datetime import date, timedelta
from decimal import Decimal

import pytest

from depotlens.config import EngineConfig
from depotlens.operators import marts, reporting
from depotlens.sources.transactions import stores_table

CFG = EngineConfig()
ITEM = (
    "invoice_no string, stock_code string, store_id string, quantity bigint, "
    "unit_price decimal(18,4), revenue decimal(18,2), order_date date"
)
SNAPSHOT = (
    "store_id string, stock_code string, snapshot_date date, units_demanded bigint, stock_on_hand bigint, restocked boolean"
)
ANALYSIS = (
    "store_id string, stock_code string, avg_daily_demand double, avg_stock_on_hand double, "
    "days_of_supply double, stockout_days long, turnover_ratio double"
)
DAILY = "store_id string, metric_date date, revenue decimal(28,2), orders_count bigint, units_sold bigint"
MONDAY = date(2011, 10, 3)


def daily(spark, *rows):
    return spark.createDataFrame([(s, d, Decimal(str(r)), 1, 1) for s, d, r in rows], DAILY)


def test_an_invoice_counts_once_per_store_and_day(spark):
    rows = [("1", s, "LON", 2, Decimal(1), Decimal("2.00"), MONDAY) for s in "AB"]
    rows += [("2", "A", "LON", 1, Decimal(1), Decimal("1.50"), MONDAY), ("2", "A", "MAN", 1, Decimal(1), Decimal("1.00"), MONDAY)]
    got = {r["store_id"]: r for r in marts.store_daily_metrics(spark.createDataFrame(rows, ITEM)).collect()}
    assert (got["LON"]["orders_count"], got["LON"]["units_sold"], got["LON"]["revenue"]) == (2, 5, Decimal("5.50"))
    assert got["MAN"]["orders_count"] == 1


def test_profit_of_a_losing_month_rounds_from_unrounded_parts(spark):
    sold = ((date(2011, 10, 5), "1000.01"), (date(2011, 10, 30), "0.01"), (date(2011, 11, 1), "50000"))
    rows = daily(spark, *(("FAR", d, v) for d, v in sold))
    got = {r["month"]: r for r in marts.store_profitability(rows, stores_table(spark, CFG), CFG).collect()}
    october = got[date(2011, 10, 1)]
    assert october["revenue"] == Decimal("1000.02")
    assert october["cogs_estimate"] == Decimal("420.01")
    assert october["opex_estimate"] == Decimal("12000.00")
    assert october["profit_estimate"] == Decimal("-11419.99")
    assert october["roi_pct"] == -95.17
    assert got[date(2011, 11, 1)]["profit_estimate"] == Decimal("17000.00")


def test_correlation_matches_and_is_null_when_undefined(spark):
    weeks = [MONDAY + timedelta(days=7 * i) for i in range(4)]
    rows = [("A", w, v) for w, v in zip(weeks, (1, 3, 5))] + [("B", w, v) for w, v in zip(weeks, (2, 7, 3))]
    rows += [("C", weeks[0], 9), ("D", weeks[0], 4), ("D", weeks[1], 4), ("D", weeks[2], 4)]
    rows += [("A", weeks[3] + timedelta(days=6), 100)]
    got = {(r[0], r[1]): r[2] for r in marts.cross_store_correlation(daily(spark, *rows)).collect()}
    assert got["A", "B"] == pytest.approx(0.188982, abs=1e-6)
    assert got["A", "C"] is None and got["A", "D"] is None
    assert ("B", "A") not in got and ("A", "A") not in got


def test_inventory_health_guards_zero(spark):
    rows = [("S", "A", MONDAY, 10, 290, False), ("S", "A", MONDAY, 20, 300, True)]
    rows += [("S", "B", MONDAY, 0, 300, False), ("S", "C", MONDAY, 5, 0, True)]
    got = {r["stock_code"]: r for r in marts.inventory_analysis(spark.createDataFrame(rows, SNAPSHOT), CFG).collect()}
    assert got["A"]["days_of_supply"] == pytest.approx(295 / 15)
    assert got["A"]["turnover_ratio"] == pytest.approx(15 * 365 / 295)
    assert got["A"]["stockout_days"] == 1
    assert got["B"]["days_of_supply"] is None and got["B"]["turnover_ratio"] == 0.0
    assert got["C"]["turnover_ratio"] is None


def test_weekly_chart_labels_sundays(spark):
    rows = daily(spark, ("LON", date(2011, 10, 12), 1), ("LON", date(2011, 10, 30), 2))
    got = {r["week_end"]: r["revenue"] for r in reporting.weekly_revenue(rows, stores_table(spark, CFG)).collect()}
    want = {date(2011, 10, 16): "1.00", date(2011, 10, 23): "0.00", date(2011, 10, 30): "2.00"}
    assert got == {day: Decimal(value) for day, value in want.items()}


def test_measures_are_ratios_of_sums_and_blank_on_zero(spark):
    schema = "g string, revenue decimal(10,2), orders_count int"
    rows = spark.createDataFrame([("x", Decimal(10), 1), ("x", Decimal(20), 4), ("y", Decimal(5), 0)], schema)
    got = {r["g"]: r["avg_order_value"] for r in reporting.measures(rows, ["avg_order_value"], ["g"]).collect()}
    assert got == {"x": 6.0, "y": None}


def test_views_keep_products_without_description(spark):
    stores = stores_table(spark, CFG)
    rows = [("LON", "A", 1.0, 2.0, 2.0, 0, 9.0), ("XXX", "A", 1.0, 2.0, 2.0, 0, 9.0)]
    analysis = spark.createDataFrame(rows, ANALYSIS)
    products = spark.createDataFrame([], "stock_code string, description string")
    got = reporting.inventory_summary(analysis, stores, products).collect()
    assert [(r["store_name"], r["description"]) for r in got] == [("London Dark Store", None)]


def test_store_count_ignores_the_pick(spark):
    rows = daily(spark, ("LON", MONDAY, 5), ("MAN", MONDAY, 7))
    got = reporting.dashboard_totals(rows, stores_table(spark, CFG), ["London Dark Store"]).first()
    assert (got["total_revenue"], got["total_orders"], got["stores"]) == (Decimal("5.00"), 1, 6)


def test_a_page_is_one_pass(spark):
    from depotlens.operators import reporting

    sales = spark.createDataFrame([("L", "N", 10, 2), ("L", "N", 5, 1), ("M", "N", 1, 0), (None, "S", 4, 4)], "store_name string, region string, revenue int, orders_count int")
    visuals = {"card": (), "by_store": ("store_name",), "again": ("store_name",), "by_region": ("region",), "both": ("region", "store_name")}
    names = ("total_revenue", "avg_order_value")
    found = reporting.page(sales, visuals, names)
    got = {(r["visual"], r["store_name"], r["region"]): (r["total_revenue"], r["avg_order_value"]) for r in found.collect()}
    want = {}
    for visual, by in visuals.items():
        for r in reporting.measures(sales, names, by).collect():
            key = (visual, r["store_name"] if "store_name" in by else None, r["region"] if "region" in by else None)
            want[key] = (r["total_revenue"], r["avg_order_value"])
    assert got == want and len(got) == 1 + 3 + 3 + 2 + 3
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD") == 1 and "Expand" in plan
    cards = reporting.page(sales, {"card": ()}, names, sales["revenue"] > 4).collect()
    assert [(r["visual"], r["total_revenue"]) for r in cards] == [("card", 15)]
