"""Row filters and order routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.config import EngineConfig, RoutingRule
from depotlens.functions.hashing import md5_mod


def clean_transactions(log: DataFrame) -> DataFrame:
    """Drop cancelled invoices (upper-case ``C`` prefix) and lines without a positive quantity and price.

    A NULL invoice stays, so that validation counts and quarantines it.
    """
    invoice = F.col("invoice_no").cast("string")
    kept = F.coalesce(~invoice.startswith("C"), F.lit(True))
    return log.where(
        kept & (F.col("quantity") > 0) & (F.col("unit_price") > 0) & F.col("stock_code").isNotNull()
    ).withColumns({"invoice_no": invoice, "stock_code": F.col("stock_code").cast("string")})


def store_of(rule: RoutingRule) -> Column:
    """The fulfilment store as a native expression; a NULL country goes to the fallback store."""
    customer = F.col("customer_id").cast("bigint").cast("string")
    if rule.float_key_compat:
        customer = F.concat(customer, F.lit(".0"))
    slot = md5_mod(F.coalesce(customer, F.col("invoice_no").cast("string")), len(rule.home_stores))
    # The slot is always in range; the coalesce only tells Catalyst that a store is never NULL.
    home = F.coalesce(F.element_at(F.array(*map(F.lit, rule.home_stores)), slot + 1), F.lit(rule.fallback_store))
    store = F.when(F.col("country") == rule.home_country, home)
    for target, countries in rule.country_groups:
        store = store.when(F.col("country").isin(*countries), F.lit(target))
    return store.otherwise(F.lit(rule.fallback_store))


def route_orders(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    return lines.withColumn("store_id", store_of(cfg.routing))
