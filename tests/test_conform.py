import random
import statistics
from collections import Counter
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

from frames import line, transactions

from depotlens.config import EngineConfig
from depotlens.operators.cleaning import route_orders
from depotlens.operators.conform import build_order_items, build_orders, build_products

CFG = EngineConfig()


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_description_ties_go_to_the_lowest_and_nulls_do_not_count(spark):
    names = ["b", "a", "b", "a", None, None, None]
    rows = transactions(spark, *(line(description=d) for d in names), line(stock="B", description=None))
    products = by(build_products(rows), "stock_code")
    assert products["A"]["description"] == "a"
    assert products["B"]["description"] is None


def test_median_of_odd_even_and_repeated_prices(spark):
    prices = {"odd": ["1", "9", "2"], "even": ["1.25", "3.10", "2.50", "2.60"], "same": ["7.5"] * 6, "span": ["0.001", "99999"]}
    rows = transactions(spark, *(line(stock=s, price=p) for s, ps in prices.items() for p in ps))
    products = by(build_products(rows), "stock_code")
    for stock, ps in prices.items():
        assert products[stock]["reference_unit_price"] == statistics.median(Decimal(p) for p in ps)


def test_products_match_brute_force_with_a_hot_product(spark):
    draw = random.Random(3)
    rows = []
    for i in range(3000):
        stock = "hot" if draw.random() < 0.4 else f"p{draw.randrange(30)}"
        rows.append((stock, draw.choice(["x", "y", "z", None]), Decimal(draw.randrange(1, 400000)) / 10000))
    df = transactions(spark, *(line(stock=s, description=d, price=str(p)) for s, d, p in rows))
    got = by(build_products(df), "stock_code")
    for stock in {s for s, _, _ in rows}:
        prices = [p for s, _, p in rows if s == stock]
        names = Counter(d for s, d, _ in rows if s == stock and d)
        best = min(names, key=lambda d: (-names[d], d)) if names else None
        assert got[stock]["reference_unit_price"] == statistics.median(prices)
        assert got[stock]["description"] == best


def test_order_header_takes_the_first_present_values_and_the_earliest_time(spark):
    rows = route_orders(
        transactions(
            spark,
            line("1", customer=None, country=None, hour=12, line_no=1),
            line("1", customer=7, country="EIRE", hour=8, line_no=3),
            line("1", customer=9, country="France", hour=10, line_no=2),
            line("2", customer=None, country="EIRE"),
        ),
        CFG,
    )
    orders = by(build_orders(rows), "invoice_no")
    first = orders["1"]
    assert (first["store_id"], first["customer_id"], first["country"]) == ("FAR", "9", "France")
    assert first["order_date"] == datetime(2011, 10, 1, 8)
    assert orders["2"]["customer_id"] is None


def test_items_use_the_first_price(spark):
    rows = route_orders(
        transactions(
            spark,
            line("1", quantity=2, price="3.00", line_no=5, hour=23),
            line("1", quantity=1, price="10.00", line_no=4, hour=22),
        ),
        CFG,
    )
    item = build_order_items(rows, CFG).first()
    assert (item["quantity"], item["unit_price"], item["revenue"]) == (3, Decimal("10.0000"), Decimal("30.00"))
    assert item["order_date"] == date(2011, 10, 1)
    summed = build_order_items(rows, replace(CFG, line_revenue=True)).first()
    assert summed["revenue"] == Decimal("16.00")


def test_revenue_rounds_half_to_even(spark):
    rows = route_orders(transactions(spark, line("1", price="0.125"), line("2", price="0.375")), CFG)
    items = by(build_order_items(rows, CFG), "invoice_no")
    assert [items["1"]["revenue"], items["2"]["revenue"]] == [Decimal("0.12"), Decimal("0.38")]
