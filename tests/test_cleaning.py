import hashlib
from dataclasses import replace

from frames import line, transactions
from pyspark.sql import functions as F

from depotlens.config import CONTINENTAL_COUNTRIES, EngineConfig, RoutingRule
from depotlens.functions.hashing import md5_mod
from depotlens.operators.cleaning import clean_transactions, route_orders

CFG = EngineConfig()


def home_store(key):
    return ["LON", "MAN", "EDI"][int(hashlib.md5(key.encode()).hexdigest(), 16) % 3]


def test_cancelled_and_worthless_lines_are_dropped(spark):
    rows = transactions(
        spark,
        line("C1"),
        line("c2"),
        line("3", quantity=0),
        line("4", quantity=-5),
        line("5", price="0"),
        line("6", stock=None),
        line("7", quantity=None),
        line(None),
        line("8"),
    )
    assert {r["invoice_no"] for r in clean_transactions(rows).collect()} == {"c2", "8", None}


def test_md5_modulo_matches_big_integers(spark):
    keys = [str(i) for i in range(500)] + ["17850.0", "", "ünïcode"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (3, 7, 1000):
        for row in df.select("k", md5_mod(F.col("k"), n).alias("m")).collect():
            assert row["m"] == int(hashlib.md5(row["k"].encode()).hexdigest(), 16) % n


def test_every_routing_branch(spark):
    rows = transactions(
        spark,
        line("1", customer=17850),
        line("536365", customer=None),
        line("2", country="Ireland"),
        line("3", country="EIRE"),
        *(line(c, country=c) for c in CONTINENTAL_COUNTRIES),
        line("4", country="USA"),
        line("5", country=None),
    )
    routed = {r["invoice_no"]: r["store_id"] for r in route_orders(rows, CFG).collect()}
    assert routed.pop("1") == home_store("17850")
    assert routed.pop("536365") == home_store("536365")
    assert [routed.pop(k) for k in "2345"] == ["DUB", "DUB", "FAR", "FAR"]
    assert set(routed.values()) == {"AMS"} and len(routed) == 17


def test_customers_are_total_and_stable(spark):
    rows = transactions(spark, *(line(str(i), customer=i % 40) for i in range(200)))
    routed = route_orders(rows, CFG)
    assert routed.where(F.col("store_id").isNull()).count() == 0
    per_customer = routed.groupBy("customer_id").agg(F.countDistinct("store_id").alias("n"))
    assert per_customer.where("n != 1").count() == 0


def test_float_text_of_the_customer_is_an_option(spark):
    cfg = replace(CFG, routing=RoutingRule(float_key_compat=True))
    rows = transactions(spark, *(line(str(i), customer=c) for i, c in enumerate((17850, 12345678, 13))))
    for row in route_orders(rows, cfg).collect():
        assert row["store_id"] == home_store(f"{row['customer_id']}.0")


def test_routing_needs_no_python(spark):
    plan = route_orders(transactions(spark, line()), CFG)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
