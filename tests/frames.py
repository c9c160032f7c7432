"""Tiny literal frames."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from depotlens.schemas import TRANSACTIONS

START = date(2011, 10, 1)


def day(n: int) -> date:
    return START + timedelta(days=n)


def line(invoice="1", stock="A", description="thing", quantity=1, price="2.50", customer=10, country="United Kingdom",
         hour=9, line_no=0, on=START):
    moment = datetime(on.year, on.month, on.day, hour)
    return (invoice, stock, description, quantity, moment, Decimal(price), customer, country, line_no)


def transactions(spark, *lines):
    return spark.createDataFrame(list(lines), TRANSACTIONS)


def panel(spark, series: dict[tuple[str, str], list[int]], start: date = START):
    rows = [
        (store, stock, start + timedelta(days=i), units)
        for (store, stock), values in series.items()
        for i, units in enumerate(values)
    ]
    return spark.createDataFrame(rows, "store_id string, stock_code string, snapshot_date date, units_demanded bigint")
