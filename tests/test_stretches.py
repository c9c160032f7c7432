import numpy as np
import pytest
from frames import day
from pyspark.sql import functions as F

from depotlens.operators.panel import replay_balance
from depotlens.operators.stretches import compose, replay_stretches, stretch_table


def plain(demand, stock, refill):
    events = 0
    for d in demand:
        stock -= d
        if stock <= 0:
            stock, events = refill, events + 1
    return stock, events


@pytest.mark.parametrize("seed", range(20))
def test_tables_and_their_composition_equal_the_replay(seed):
    rng = np.random.default_rng(seed)
    refill, levels = int(rng.integers(1, 30)), 40
    demand = rng.integers(0, [1, 5, 60][seed % 3] + 1, rng.integers(0, 80))
    cut = int(rng.integers(0, len(demand) + 1))
    whole, parts = stretch_table(demand, refill, levels), [stretch_table(d, refill, levels) for d in (demand[:cut], demand[cut:])]
    joined = compose(*parts)
    for s in range(1, levels + 1):
        want = plain(demand.tolist(), s, refill)
        assert (whole[0][s - 1], whole[1][s - 1]) == want == (joined[0][s - 1], joined[1][s - 1])


def rows(df, n):
    found = df.select("k", "d", "units", "stock_on_hand", "restocked").collect()
    assert len(found) == n
    return sorted(map(tuple, found))


@pytest.mark.parametrize("most_rows", [1, 7, 100_000])
def test_equals_the_fold(spark, most_rows):
    rng = np.random.default_rng(most_rows)
    given = [(k, day(i), int(u), 9) for k in "abc" for i, u in enumerate(rng.integers(0, 90, 40 if k != "b" else 1))]
    df = spark.createDataFrame(given, "k string, d date, units int, _series int").drop("_series").repartition(3)
    got = replay_stretches(df, ["k"], "d", "units", 50, 80, most_rows)
    assert rows(got, 81) == rows(replay_balance(df, ["k"], "d", "units", F.lit(50), F.lit(80)), 81)
    assert replay_stretches(df.limit(0), ["k"], "d", "units", 50, 80).count() == 0
    with pytest.raises(ValueError, match="above zero"):
        replay_stretches(df, ["k"], "d", "units", 0, 80)


def test_a_series_of_a_million_days_is_spread_over_tasks(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("one").alias("k"), F.col("id").alias("d"), F.pmod(F.xxhash64("id"), F.lit(23)).alias("units"))
    got = replay_stretches(df, ["k"], "d", "units", 300, 300, 60_000)
    stretches = got.inputFiles()
    assert len(stretches) > 1  # several range partitions hold the one series
    want = replay_balance(df, ["k"], "d", "units", F.lit(300), F.lit(300))
    sums = [F.count("*"), F.sum("stock_on_hand"), F.count_if("restocked"), F.sum(F.xxhash64("d", "stock_on_hand", "restocked").cast("decimal(38,0)"))]
    assert tuple(got.agg(*sums).first()) == tuple(want.agg(*sums).first())
