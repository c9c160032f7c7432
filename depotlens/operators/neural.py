"""A feed-forward network for regression, trained by mini-batches whose gradients are summed over all tasks.

Every block of rows gives its share to each mini-batch, so all tasks work on every step; the driver holds the
weights alone and makes the step (Adam). A block's gradient is rounded to a fixed binary scale and summed as an
integer, and blocks do not depend on the partitioning, so neither do the weights.

Features and label are standardised. Hidden layers use tanh; the loss is the pseudo-Huber loss
d^2 (sqrt(1 + (error / d)^2) - 1), close to the squared error for small errors and to the absolute one for large.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame

from depotlens.operators.learning import ArrayModel, Rows, run_on, training_blocks

#: Gradients are means over a batch; so many binary places of them are kept.
PLACES = 2.0**36


@dataclass(frozen=True)
class NetworkSettings:
    hidden: tuple[int, ...] = (32, 16)
    epochs: int = 40
    batch_rows: int = 1024
    rate: float = 0.01
    delta: float = 0.3
    decay: float = 1e-4
    seed: int = 7


Layers = list[tuple[np.ndarray, np.ndarray]]


def initial_layers(sizes: list[int], seed: int) -> Layers:
    rng = np.random.default_rng(seed)
    return [(rng.normal(0, 1 / math.sqrt(a), (a, b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]


def forward(layers: Layers, x: np.ndarray) -> list[np.ndarray]:
    """The input, the output of every hidden layer, and the prediction."""
    out = [x]
    for i, (weight, bias) in enumerate(layers):
        z = out[-1] @ weight + bias
        out.append(z if i == len(layers) - 1 else np.tanh(z))
    return out


def loss_and_gradient(layers: Layers, x: np.ndarray, y: np.ndarray, w: np.ndarray, delta: float) -> tuple[float, Layers]:
    """The weighted sum of the loss over the rows and its gradient, by backpropagation."""
    out = forward(layers, x)
    error = out[-1][:, 0] - y
    root = np.sqrt(1 + (error / delta) ** 2)
    back = (w * error / root)[:, None]
    gradient: Layers = []
    for i in range(len(layers) - 1, -1, -1):
        gradient.append((out[i].T @ back, back.sum(axis=0)))
        if i:
            back = (back @ layers[i][0].T) * (1 - out[i] ** 2)
    return float((w * delta**2 * (root - 1)).sum()), gradient[::-1]


def flat(layers: Layers) -> np.ndarray:
    return np.concatenate([part.ravel() for layer in layers for part in layer])


def shaped(values: np.ndarray, like: Layers) -> Layers:
    out, at = [], 0
    for layer in like:
        parts = []
        for part in layer:
            parts.append(values[at : at + part.size].reshape(part.shape))
            at += part.size
        out.append(tuple(parts))
    return out


def moments(rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, deviation, weight) of every feature and, last, the label, from sums that do not depend on the order."""

    def widest(block) -> np.ndarray:
        return np.abs(np.column_stack([block[0], block[1]])).max(axis=0)

    weight = float(rows.reduce(lambda b: np.array([b[2].sum()]).astype(np.int64))[0])
    most = np.maximum(rows.reduce(widest, np.maximum), 1e-300)
    # Shares of the largest value are summed with as many binary places as 62 bits leave.
    scale = 2.0 ** math.floor(60 - math.log2(max(1.0, weight)))

    def sums(centre: np.ndarray, unit: np.ndarray, power: int):
        def part(block) -> np.ndarray:
            values = ((np.column_stack([block[0], block[1]]) - centre) / unit) ** power
            return np.rint((block[2][:, None] * values).sum(axis=0) * scale).astype(np.int64)

        return part

    mean = rows.reduce(sums(np.zeros(len(most)), most, 1)) / scale / weight * most
    # No value is further from the mean than twice the largest one.
    variance = rows.reduce(sums(mean, 2 * most, 2)) / scale / weight
    spread = np.sqrt(variance) * 2 * most
    return mean, np.where(spread > 0, spread, 1.0), np.array(weight)


def train(rows: Rows, settings: NetworkSettings) -> dict:
    """The weights and standardisation as plain lists."""
    mean, spread, weight = moments(rows)
    layers = initial_layers([len(mean) - 1, *settings.hidden, 1], settings.seed)
    distinct = rows.reduce(lambda b: np.array([len(b[1])], dtype=np.int64))[0]
    batches = max(1, math.ceil(distinct / settings.batch_rows))
    share = float(weight) / batches
    values, first, second, step = flat(layers), 0.0, 0.0, 0

    def batch_gradient(layers: Layers, batch: int):
        def part(block) -> np.ndarray:
            # A block's rows stand in the order of a hash: each batch takes its stretch of them.
            n = len(block[1])
            own = slice(n * batch // batches, n * (batch + 1) // batches)
            x, y = (block[0][own] - mean[:-1]) / spread[:-1], (block[1][own] - mean[-1]) / spread[-1]
            _, gradient = loss_and_gradient(layers, x, y, block[2][own], settings.delta)
            return np.rint(flat(gradient) / share * PLACES).astype(np.int64)

        return part

    for epoch in range(settings.epochs):
        rate = settings.rate * 0.5 * (1 + math.cos(math.pi * epoch / settings.epochs))
        for batch in np.random.default_rng((settings.seed, epoch)).permutation(batches).tolist():
            gradient = rows.reduce(batch_gradient(shaped(values, layers), batch)) / PLACES
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            ahead = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            values = values - rate * (ahead + settings.decay * values)
    return {
        "layers": [[part.tolist() for part in layer] for layer in shaped(values, layers)],
        "mean": mean.tolist(),
        "spread": spread.tolist(),
    }


class NeuralRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    def __init__(self, settings: NetworkSettings = NetworkSettings(), labelCol="label", featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self.settings = settings
        self._set(labelCol=labelCol, featuresCol=featuresCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> NeuralModel:
        blocks = training_blocks(dataset, self.getFeaturesCol(), self.getLabelCol())
        try:
            settings = self.settings
            values = run_on(blocks, lambda rows: train(rows, settings))
        finally:
            blocks.unpersist()
        return NeuralModel(values, self.getFeaturesCol(), self.getPredictionCol())


class NeuralModel(ArrayModel):
    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        mean, spread = (np.array(self.values[n]) for n in ("mean", "spread"))
        layers = [tuple(np.array(part) for part in layer) for layer in self.values["layers"]]
        out = forward(layers, (x - mean[:-1]) / spread[:-1])[-1][:, 0]
        return out * spread[-1] + mean[-1]
