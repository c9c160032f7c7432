"""The transaction log derived from star-schema order tables (orders, lineitem, customer, nation, region, part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Region of the customer -> country of the log, so that every routing branch occurs.
REGION_COUNTRIES = {"ASIA": "United Kingdom", "EUROPE": "Germany", "AMERICA": "EIRE"}


def sales_log(spark: SparkSession, sf_dir: str, grain: str = "part", described: bool = True) -> DataFrame:
    """Returned lines play the cancelled invoices; ``grain`` is the product level, ``part`` or ``type``.

    The dimension joins run on the order header, before the fact join, so customer attributes are
    attached once per order and not once per line. At part grain the description is the only reason
    to join ``part`` to every line; ``described=False`` leaves it NULL and saves that join.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    country = F.col("n_name")
    for region, name in REGION_COUNTRIES.items():
        country = F.when(F.col("r_name") == region, name).otherwise(country)
    places = (
        table("nation")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", country.alias("country"))
    )
    customers = table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    headers = (
        table("orders")
        .join(customers.select("c_custkey", "country"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "o_custkey", "country")
    )
    cents = F.col("l_extendedprice").cast("decimal(18,2)")
    cancelled = F.when(F.col("l_returnflag") == "R", "C").otherwise("")
    # Line number, ship date, quantity and price packed into one long: the order of lines in the log.
    position = (
        (F.col("l_linenumber").cast("bigint") * 100_000 + F.unix_date(F.to_date("l_shipdate"))) * 100
        + F.col("l_quantity").cast("bigint")
    ) * 100_000_000 + (cents * 100).cast("bigint")
    lines = table("lineitem").join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    described = described or grain == "type"
    if described:
        parts = table("part").select("p_partkey", "p_name", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    product = F.col("p_type") if grain == "type" else F.col("l_partkey").cast("string")
    return lines.select(
        F.concat(cancelled, F.col("l_orderkey").cast("string")).alias("invoice_no"),
        product.alias("stock_code"),
        (F.col("p_name") if described else F.lit(None).cast("string")).alias("description"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("invoice_date"),
        cents.cast("decimal(18,4)").alias("unit_price"),
        F.col("o_custkey").alias("customer_id"),
        F.col("country"),
        position.alias("line_no"),
    )
