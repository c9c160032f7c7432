import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from test_boosting import frame

from depotlens.operators import neural
from depotlens.operators.learning import HeldRows, SpreadRows, training_blocks
from depotlens.operators.neural import NetworkSettings, NeuralRegressor


@pytest.mark.parametrize("hidden", [(), (4,), (5, 3)])
def test_gradient_equals_differences(hidden):
    rng = np.random.default_rng(1)
    layers = neural.initial_layers([3, *hidden, 1], 2)
    x, y, w = rng.normal(size=(20, 3)), rng.normal(size=20), rng.integers(1, 5, 20).astype(float)
    values = neural.flat(layers)
    _, gradient = neural.loss_and_gradient(layers, x, y, w, 0.3)
    for i, slope in enumerate(neural.flat(gradient)):
        ends = []
        for step in (1e-6, -1e-6):
            moved = values.copy()
            moved[i] += step
            ends.append(neural.loss_and_gradient(neural.shaped(moved, layers), x, y, w, 0.3)[0])
        assert slope == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-5, abs=1e-6)


def data(n=600):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.uniform(-2, 2, n), rng.normal(100, 20, n), np.ones(n)]).round(3)
    return x, (np.abs(x[:, 0]) * 30 + x[:, 1] + rng.normal(size=n)).round(3)


def test_standardisation_counts_repeated_rows(spark):
    x, y = data(50)
    x, y = np.concatenate([x, np.repeat(x[:1], 30, axis=0)]), np.concatenate([y, np.repeat(y[:1], 30)])
    mean, spread, weight = neural.moments(SpreadRows(training_blocks(frame(spark, x, y), "features", "y")))
    both = np.column_stack([x, y])
    assert weight == 80 and np.allclose(mean, both.mean(axis=0), atol=1e-9)
    assert np.allclose(spread, np.where(both.std(axis=0) > 1e-9, both.std(axis=0), 1.0), atol=1e-6)


def test_learns_what_a_line_cannot_and_is_stored(spark, tmp_path):
    x, y = data()
    settings = NetworkSettings(hidden=(16,), epochs=25, batch_rows=128)
    model = Pipeline(stages=[NeuralRegressor(settings, labelCol="y")]).fit(frame(spark, x[:450], y[:450]))
    test = frame(spark, x[450:], y[450:])
    rows = model.transform(test).collect()
    error = np.mean([abs(r["prediction"] - r["y"]) for r in rows])
    line = np.linalg.lstsq(x[:450], y[:450], rcond=None)[0]
    assert error < 0.75 * np.abs(x[450:] @ line - y[450:]).mean()
    model.write().overwrite().save(str(tmp_path / "model"))
    assert PipelineModel.load(str(tmp_path / "model")).transform(test).collect() == rows


def test_same_weights_for_any_partitioning(spark):
    x, y = data(300)
    settings = NetworkSettings(hidden=(6, 4), epochs=3, batch_rows=64)
    one = NeuralRegressor(settings, labelCol="y")._fit(frame(spark, x, y, 1))
    other = NeuralRegressor(settings, labelCol="y")._fit(frame(spark, x[::-1].copy(), y[::-1].copy(), 6))
    assert one.values == other.values


def test_many_partitions_give_the_weights_of_one_task(spark):
    x, y = data(300)
    blocks = training_blocks(frame(spark, x, y), "features", "y", block_rows=40)
    settings = NetworkSettings(hidden=(5,), epochs=2, batch_rows=100)
    spread = neural.train(SpreadRows(blocks.repartition(3), few=2), settings)
    assert blocks.count() > 3 and spread == neural.train(HeldRows(blocks.collect()), settings)
