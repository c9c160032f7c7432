import random
from collections import defaultdict
from dataclasses import replace
from datetime import timedelta

import pytest
from frames import START, day, panel
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.functions.frames import fill_calendar
from depotlens.operators.panel import (
    PAIR,
    daily_demand,
    densify_panel,
    inventory_snapshots,
    panel_overview,
    replay_balance,
    top_products,
)

CFG = EngineConfig()


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "store_id string, stock_code string, order_date date, quantity bigint")


def replayed(df, opening=300, refill=300):
    return replay_balance(df, PAIR, "snapshot_date", "units_demanded", F.lit(opening), F.lit(refill))


def brute_force(values, stock=300, refill=300):
    out = []
    for units in values:
        stock -= units
        hit = stock <= 0
        stock = refill if hit else stock
        out.append((stock, hit))
    return out


def test_worked_replay(spark):
    rows = replayed(panel(spark, {("S", "A"): [100, 250, 30, 10, 280]})).orderBy("snapshot_date").collect()
    assert [r["stock_on_hand"] for r in rows] == [200, 300, 270, 260, 300]
    assert [r["restocked"] for r in rows] == [False, True, False, False, True]


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_replay_matches_brute_force_also_across_arrow_batches(spark, batch):
    draw = random.Random(11)
    series = {(f"S{i % 3}", f"P{i}"): [draw.choice([0, 0, 5, 90, 400]) for _ in range(100)] for i in range(20)}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = defaultdict(list)
        for r in replayed(panel(spark, series)).orderBy("snapshot_date").collect():
            got[r["store_id"], r["stock_code"]].append((r["stock_on_hand"], r["restocked"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {pair: brute_force(values) for pair, values in series.items()}


def test_stock_is_conserved_between_restocks(spark):
    draw = random.Random(5)
    values = [draw.randrange(0, 120) for _ in range(200)]
    sold = 0
    for r in replayed(panel(spark, {("S", "A"): values})).orderBy("snapshot_date").collect():
        sold = 0 if r["restocked"] else sold + r["units_demanded"]
        assert r["stock_on_hand"] == 300 - sold > 0


def test_panel_is_pairs_times_days(spark):
    rows = items(spark, ("S", "A", day(2), 5), ("S", "A", day(2), 1), ("T", "A", day(9), 2), ("S", "B", day(0), 4))
    snapshots = inventory_snapshots(daily_demand(rows), CFG)
    got = {(r["store_id"], r["stock_code"], r["snapshot_date"]): r["units_demanded"] for r in snapshots.collect()}
    assert len(got) == 3 * 10
    assert got["S", "A", day(2)] == 6 and got["T", "A", day(0)] == 0 and got["T", "A", day(9)] == 2
    assert sum(got.values()) == 12
    overview = panel_overview(snapshots).first()
    assert (overview["total_rows"], overview["n_pairs"], overview["n_stores"], overview["n_products"]) == (30, 3, 2, 2)
    assert overview["pct_zero"] == pytest.approx(90.0)


def test_published_panel_sizes():
    assert 876 * 374 == 327_624 and 152 * 56 == 8_512 and 152 * (318 - 7) == 47_272


def test_densify_has_no_cross_join_and_no_join(spark):
    plan = densify_panel(panel(spark, {("S", "A"): [1, 2]}), CFG)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Join" not in plan


def test_top_products_ties_go_to_the_lower_code(spark):
    rows = items(spark, ("S", "C", START, 5), ("S", "B", START, 5), ("S", "A", START, 1), ("T", "A", START, 9))
    cfg = replace(CFG, top_n_products=2)
    assert [r["stock_code"] for r in top_products(rows, cfg, "quantity").collect()] == ["A", "B"]
    per_store = top_products(rows, replace(cfg, top_n_per_store=True, top_n_products=1), "quantity").collect()
    assert {(r["store_id"], r["stock_code"]) for r in per_store} == {("S", "B"), ("T", "A")}


def test_ranking_can_stop_before_the_test_days(spark):
    rows = items(spark, ("S", "early", day(0), 5), ("S", "late", day(9), 50))
    cfg = replace(CFG, top_n_products=1)
    assert {r["stock_code"] for r in inventory_snapshots(daily_demand(rows), cfg).collect()} == {"late"}
    assert {r["stock_code"] for r in inventory_snapshots(daily_demand(rows), replace(cfg, top_as_of=day(5))).collect()} == {"early"}


def test_calendar_does_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        df = spark.createDataFrame([("S", START, 1), ("S", day(60), 2)], "k string, d date, v int")
        got = [r["d"] for r in fill_calendar(df, ["k"], "d", "v").orderBy("d").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [day(i) for i in range(61)]


def test_weekly_gaps_inside_a_range_are_zero(spark):
    weeks = [(START, 1), (START + timedelta(days=14), 2)]
    df = spark.createDataFrame([("S", d, v) for d, v in weeks] + [("T", START, 4)], "k string, d date, v int")
    got = sorted((r["k"], r["d"], r["v"]) for r in fill_calendar(df, ["k"], "d", "v", step_days=7).collect())
    assert got == [("S", START, 1), ("S", START + timedelta(days=7), 0), ("S", START + timedelta(days=14), 2), ("T", START, 4)]
