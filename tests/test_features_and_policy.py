import random
import statistics
from dataclasses import replace
from datetime import timedelta
from decimal import Decimal

import pytest
from frames import START, day, panel
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators import features, policy

CFG = EngineConfig(test_start=day(40), numeric_features=("lag_1", "lag_7", "rolling_mean_7", "rolling_std_7", "day_of_week"))

TEST_ROWS = "store_id string, stock_code string, snapshot_date date, units_demanded bigint, f double, rolling_std_7 double"


def featured(spark, values, cfg=CFG):
    rows = features.demand_features(panel(spark, {("S", "A"): values}), cfg).orderBy("snapshot_date").collect()
    return {(r["snapshot_date"] - START).days: r for r in rows}


def test_features_match_brute_force(spark):
    draw = random.Random(2)
    values = [draw.randrange(0, 50) for _ in range(60)]
    rows = featured(spark, values)
    assert sorted(rows) == list(range(7, 60))
    for i, r in rows.items():
        week = values[i - 7 : i]
        assert (r["lag_1"], r["lag_7"]) == (values[i - 1], values[i - 7])
        assert r["rolling_mean_7"] == pytest.approx(statistics.mean(week))
        assert r["rolling_std_7"] == pytest.approx(statistics.stdev(week))
        past = [values[i - 7 * k] for k in range(1, 5) if i >= 7 * k]
        assert r["seasonal_naive_pred"] == pytest.approx(statistics.mean(past))
        assert r["day_of_week"] == (START + timedelta(days=i)).weekday()


def test_rolling_mean_excludes_its_own_day(spark):
    rows = featured(spark, list(range(1, 10)))
    assert [rows[i]["rolling_mean_7"] for i in (7, 8)] == [4.0, 5.0]
    changed = featured(spark, [1, 2, 3, 4, 5, 6, 7, 999])
    assert changed[7]["rolling_mean_7"] == 4.0 and changed[7]["lag_1"] == 7


def test_a_stricter_history_drops_four_weeks(spark):
    strict = featured(spark, list(range(60)), replace(CFG, min_seasonal_lags=4))
    assert min(strict) == 28


def test_density_looks_at_training_days_only(spark):
    frame = panel(spark, {("S", "A"): [1, 0] * 20 + [0] * 20, ("S", "B"): [0] * 40 + [5] * 20, ("S", "C"): [1, 1, 0, 0, 0] * 12})
    got = {r["stock_code"]: r["density"] for r in features.select_dense_pairs(frame, CFG).collect()}
    assert got == {"A": 0.5, "C": 0.4}


def test_missing_prices_take_the_row_weighted_median(spark):
    snapshots = panel(spark, {("S", s): [1] * 45 for s in "ABCD"}).withColumn("stock_on_hand", F.lit(1))
    prices = [("A", Decimal(1)), ("B", Decimal(5)), ("C", Decimal(9))]
    products = spark.createDataFrame(prices, "stock_code string, reference_unit_price decimal(20,5)")
    frame = features.training_frame(snapshots, products, CFG).select("stock_code", "reference_unit_price")
    assert {r[0]: r[1] for r in frame.distinct().collect()} == {"A": 1.0, "B": 5.0, "C": 9.0, "D": 5.0}


def test_restock_level(spark):
    rows = spark.createDataFrame([(10.0, 4.0), (0.0, None), (0.5, 0.0), (1.5, 0.0), (-9.0, 0.0)], "p double, s double")
    got = [r[0] for r in rows.select(policy.restock_level(F.col("p"), F.col("s"), CFG)).collect()]
    assert got == [87, 0, 4, 10, 0]
    capped = rows.select(policy.restock_level(F.col("p"), F.col("s"), replace(CFG, max_restock=50))).collect()
    assert capped[0][0] == 50


def walk(values, refills, stock):
    levels, events = [], 0
    for units, refill in zip(values, refills):
        stock -= units
        if stock <= 0:
            stock, events = refill, events + 1
        levels.append(stock)
    return events, statistics.mean(levels)


def test_policies_match_brute_force(spark):
    draw = random.Random(8)
    rows, expected = [], {}
    for i in range(12):
        values = [draw.choice([0, 20, 150, 500]) for _ in range(30)]
        preds = [draw.random() * 40 for _ in values]
        stds = [draw.choice([0.0, 12.5, None]) for _ in values]
        levels = [max(0, round(p * 7 + 1.65 * (s or 0.0) * 7**0.5)) for p, s in zip(preds, stds)]
        opening = 300 if i % 2 else 40 + i
        expected["S", f"P{i}", CFG.fixed_policy] = walk(values, [300] * 30, opening)
        expected["S", f"P{i}", CFG.forecast_policy] = walk(values, levels, opening)
        rows += [("S", f"P{i}", day(n), v, p, s) for n, (v, p, s) in enumerate(zip(values, preds, stds))]
    draw.shuffle(rows)
    test = spark.createDataFrame(rows, TEST_ROWS)
    opening = spark.createDataFrame([("S", f"P{i}", 40 + i) for i in range(0, 12, 2)], "store_id string, stock_code string, opening_stock bigint")
    got = policy.compare_policies(test, "f", opening, CFG)
    assert {(r[0], r[1], r[2]): (r[3], pytest.approx(r[4])) for r in got.collect()} == expected
    wide = policy.policy_pivot(got, CFG)
    change = policy.policy_change_summary(wide).first()
    diffs = [expected["S", f"P{i}", CFG.forecast_policy][1] - expected["S", f"P{i}", CFG.fixed_policy][1] for i in range(12)]
    assert change["pairs"] == 12 and change["median_stock_change"] == pytest.approx(statistics.median(diffs))
    assert change["pairs_lower"] == sum(d < 0 for d in diffs)
    top = [r["stock_change"] for r in policy.largest_increases(wide).collect()]
    assert top == pytest.approx(sorted(diffs, reverse=True)[:5])
    assert [r["policy_name"] for r in policy.policy_totals(got, CFG).collect()] == [CFG.fixed_policy, CFG.forecast_policy]


def test_a_zero_level_triggers_again_without_demand(spark):
    rows = [("S", "A", day(0), 300, 0.0, 0.0), ("S", "A", day(1), 0, 0.0, 0.0)]
    test = spark.createDataFrame(rows, TEST_ROWS)
    empty = spark.createDataFrame([], "store_id string, stock_code string, opening_stock bigint")
    got = {r["policy_name"]: r["stockout_days"] for r in policy.compare_policies(test, "f", empty, CFG).collect()}
    assert got == {CFG.fixed_policy: 1, CFG.forecast_policy: 2}


def test_opening_stock_filter_reaches_the_scan(spark, tmp_path):
    frame = panel(spark, {("S", "A"): list(range(60))}).withColumn("stock_on_hand", F.col("units_demanded"))
    frame.write.parquet(str(tmp_path / "s"))
    opening = policy.opening_stock(spark.read.parquet(str(tmp_path / "s")), CFG)
    assert "EqualTo(snapshot_date,2011-11-09)" in opening._jdf.queryExecution().executedPlan().toString()
    assert [r["opening_stock"] for r in opening.collect()] == [39]
