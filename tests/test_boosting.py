import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from depotlens.operators import boosting
from depotlens.operators.boosting import BoostingSettings, HistogramBoosting
from depotlens.operators.learning import HeldRows, SpreadRows, training_blocks


def frame(spark, x, y, parts=3):
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    names = [f"x{i}" for i in range(len(x[0]))]
    df = spark.createDataFrame(rows, [*names, "y"]).repartition(parts)
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(df)


def fit(df, **settings):
    return HistogramBoosting(BoostingSettings(**settings), labelCol="y")._fit(df)


def plain_boosting(x, y, rounds, depth, rate, reg, least):
    """Trees by trying every split of every node on every distinct value."""
    margin = np.full(len(y), y.mean())

    def best(rows, g):
        whole = g[rows].sum() ** 2 / (len(rows) + reg)
        found = (1e-6, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if len(left) >= least and len(right) >= least:
                    gain = g[left].sum() ** 2 / (len(left) + reg) + g[right].sum() ** 2 / (len(right) + reg) - whole
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
        return found[1]

    for _ in range(rounds):
        g, nodes = margin - y, [np.arange(len(y))]
        for _ in range(depth):
            nodes = [part for rows in nodes for part in (best(rows, g) or (rows,))]
        for rows in nodes:
            margin[rows] -= rate * g[rows].sum() / (len(rows) + reg)
    return margin


@pytest.mark.parametrize("seed,reg,least,refresh", [(1, 1.0, 1.0, 10), (2, 0.0, 5.0, 2), (3, 3.0, 2.0, 1)])
def test_equals_plain_trees(spark, seed, reg, least, refresh):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, 90), rng.normal(size=90).round(1), rng.integers(0, 2, 90)]).astype(float)
    y = (x[:, 0] * 3 + np.sin(x[:, 1]) * 10 - 7 * x[:, 2] + rng.normal(size=90)).round(3)
    model = fit(frame(spark, x, y), rounds=5, depth=3, reg_lambda=reg, min_child_weight=least, refresh=refresh)
    want = plain_boosting(x, y, 5, 3, 0.1, reg, least)
    assert np.abs(model.predict_rows(x) - want).max() < 1e-6


def test_same_trees_for_any_partitioning(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 4)).round(2)
    x[:250] = x[0]  # a third of the rows are alike
    y = np.where(x[:, 0] > 0, 5.0, -2.0) + x[:, 1] ** 2 + rng.normal(size=700) / 10
    y[:250] = y[0]
    first = fit(frame(spark, x, y, 1), rounds=12, depth=4)
    assert fit(frame(spark, x[::-1].copy(), y[::-1].copy(), 7), rounds=12, depth=4).values == first.values


def test_learns_and_keeps_learning(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-3, 3, (1500, 3))
    y = np.sin(x[:, 0]) * 4 + np.abs(x[:, 1]) + rng.normal(size=1500) / 5
    df, unseen = frame(spark, x[:1000], y[:1000]), x[1000:]
    errors = [np.abs(fit(df, rounds=r, depth=4).predict_rows(unseen) - y[1000:]).mean() for r in (1, 10, 40)]
    assert errors[0] > errors[1] > errors[2] and errors[2] < 0.45


def test_missing_values_stored_models_and_clashing_names(spark, tmp_path):
    x = [[1.0, math.nan], [2.0, 5.0], [3.0, math.nan], [4.0, 6.0]] * 5
    y = [1.0, 9.0, 1.0, 9.0] * 5
    df = frame(spark, x, y).withColumns({n: F.lit(1) for n in ("x", "w", "h", "block", "value")})
    model = Pipeline(stages=[HistogramBoosting(BoostingSettings(rounds=90, depth=2), labelCol="y")]).fit(df)
    got = {(r["y"], round(r["prediction"])) for r in model.transform(df).collect()}
    assert got == {(1.0, 1), (9.0, 9)}
    model.write().overwrite().save(str(tmp_path / "model"))
    back = PipelineModel.load(str(tmp_path / "model"))
    assert back.stages[0].values == model.stages[0].values
    assert back.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()


def test_many_values_are_cut_at_quantiles(spark):
    df = frame(spark, [[float(i), float(i % 7)] for i in range(3000)], [0.0] * 3000)
    cuts = boosting.feature_cuts(df, "features", 32)
    assert len(cuts[0]) == 31 and np.abs(np.diff(cuts[0]) - 3000 / 31).max() < 3
    assert cuts[1].tolist() == [0, 1, 2, 3, 4, 5]
    bins = boosting.to_bins(np.array([[-5.0, 0.0], [2999.0, 6.0], [math.nan, 3.0], [cuts[0][4], 2.5]]), cuts)
    assert bins.tolist() == [[0, 0], [31, 6], [0, 3], [4, 3]]


def test_many_partitions_give_the_trees_of_one_task(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 3)).round(1)
    df = frame(spark, x, np.abs(x[:, 0]) + x[:, 1])
    blocks, cuts = training_blocks(df, "features", "y", block_rows=60), boosting.feature_cuts(df, "features", 256)
    settings = BoostingSettings(rounds=5, depth=3, refresh=2)
    base, trees = boosting.boost(SpreadRows(blocks.repartition(4), few=2), cuts, settings)
    again, held = boosting.boost(HeldRows(blocks.collect()), cuts, settings)
    assert blocks.count() > 4 and base == again
    for a, b in zip(trees, held, strict=True):
        assert all((getattr(a, n) == getattr(b, n)).all() for n in ("feature", "bin", "value"))
