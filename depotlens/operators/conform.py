"""Products, order headers and order items from cleaned, routed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.functions.statistics import most_frequent, weighted_median


def first_present(name: str) -> Column:
    """The first non-NULL value in log order."""
    return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("line_no")))


def product_names(lines: DataFrame) -> DataFrame:
    """The most frequent description per product: the lowest on ties, NULLs ignored."""
    counts = lines.groupBy("stock_code", "description").agg(F.count("*").alias("n"))
    return most_frequent(counts, "stock_code", "description", "n")


def product_prices(lines: DataFrame) -> DataFrame:
    """The median price per product, over counts per (product, price)."""
    counts = lines.groupBy("stock_code", "unit_price").agg(F.count("*").alias("n"))
    priced = weighted_median(counts, "stock_code", "unit_price", "n", "reference_unit_price")
    return priced.withColumn("reference_unit_price", F.col("reference_unit_price").cast("decimal(20,5)"))


def build_products(lines: DataFrame) -> DataFrame:
    """Most frequent description and median price per product.

    Both are derived from map-side counts, so a product with a large share of the lines costs what its
    distinct values cost. Consumers of one of the two ask for that one alone.
    """
    return product_names(lines).join(product_prices(lines), "stock_code")


def build_orders(lines: DataFrame, mark_split: bool = False) -> DataFrame:
    """One header per invoice: first store, customer and country, earliest time.

    ``mark_split`` adds whether the lines of the invoice went to more than one store.
    """
    columns = [
        first_present("store_id").alias("store_id"),
        F.min("invoice_date").alias("order_date"),
        first_present("customer_id").cast("string").alias("customer_id"),
        first_present("country").alias("country"),
    ]
    if mark_split:
        columns.append((F.min("store_id") != F.max("store_id")).alias("is_split"))
    return lines.groupBy("invoice_no").agg(*columns)


def build_order_items(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One item per invoice, product and store; revenue is total quantity x first price."""
    total = F.sum("quantity")
    price = first_present("unit_price")
    amount = F.sum(F.col("quantity") * F.col("unit_price")) if cfg.line_revenue else total * price
    return lines.groupBy("invoice_no", "stock_code", "store_id").agg(
        total.alias("quantity"),
        price.alias("unit_price"),
        F.bround(amount, 2).cast("decimal(18,2)").alias("revenue"),
        F.to_date(F.min("invoice_date")).alias("order_date"),
    )
