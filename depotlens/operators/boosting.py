"""Gradient boosting of regression trees from histograms, with second-order leaf weights.

Features are binned once. A tree grows level by level: tasks sum gradients and hessians per node, feature and bin,
one aggregate per level, and the driver picks each node's split from the sums by the regularised gain

    GL^2 / (HL + reg) + GR^2 / (HR + reg) - G^2 / (H + reg),

where G and H are sums of gradients and hessians and reg is ``reg_lambda``; a leaf is worth -rate * G / (H + reg).
The loss is half the squared error, so a row's hessian is its weight. Gradients are rounded to a fixed
binary scale and summed as integers: the trees are the same for any partitioning, and equal gains go to the
first feature and the lowest bin. A missing value (NaN) counts as smaller than all others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.operators.learning import ArrayModel, HeldRows, Rows, run_on, training_blocks


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 300
    depth: int = 5
    rate: float = 0.1
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    max_bins: int = 256
    #: After so many trees the rows' predictions are stored anew; until then tasks add up the trees since.
    refresh: int = 10


@dataclass
class Tree:
    """A complete tree of fixed depth: split feature and bin per inner node in heap order, value per leaf.

    A node that is not split sends all rows to the left.
    """

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    def leaf(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node each row has reached after so many levels, counted from the left."""
        node, row = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        for _ in range(levels):
            node = 2 * node + 1 + (bins[row, self.feature[node]] > self.bin[node])
        return node - ((1 << levels) - 1)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(bins, len(self.value).bit_length() - 1)]


def feature_cuts(rows: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Per feature the upper bounds of all bins but the last: quantiles, or all values where they are few."""
    array = vector_to_array(F.col(features))
    size = rows.select(F.size(array)).first()[0]
    shares = [i / (max_bins - 1) for i in range(max_bins - 1)]
    # Of a feature with few values every value is a quantile only if it is frequent: those are listed as they are.
    each = rows.select(F.posexplode(array).alias("feature", "value")).where(~F.isnan("value"))
    counted = each.groupBy("feature", "value").agg(F.count("*").alias("n"))
    found = counted.groupBy("feature").agg(
        F.count("*").alias("values"),
        F.percentile_approx("value", shares, 100_000).alias("quantiles"),
    )
    cuts: list[np.ndarray] = [np.zeros(0)] * size
    few = [r["feature"] for r in found.where(F.col("values") < max_bins).collect()]  # one row per feature
    for r in found.where(F.col("values") >= max_bins).collect():
        cuts[r["feature"]] = np.unique(np.array(r["quantiles"]))
    for r in counted.where(F.col("feature").isin(few)).groupBy("feature").agg(F.collect_list("value").alias("v")).collect():
        cuts[r["feature"]] = np.unique(np.array(r["v"]))[:-1]  # fewer than max_bins values per feature
    return cuts


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of every value: how many cuts are below it."""
    bins = np.zeros(x.shape, dtype=np.uint8)
    for f, bounds in enumerate(cuts):
        bins[:, f] = np.searchsorted(bounds, x[:, f], "left")
        bins[np.isnan(x[:, f]), f] = 0
    return bins


def level_sums(tree: Tree, level: int, since: list[Tree], scale: float, n_bins: int):
    """A block's part of the sums: gradient (scaled) and weight per left node of the level, feature and bin.

    A right node's sums are its parent's without the left one's.
    """

    def part(block) -> np.ndarray:
        bins, y, w, margin = block
        if level:
            node = tree.leaf(bins, level)
            left = np.flatnonzero(node % 2 == 0)
            bins, y, w, margin, node = bins[left], y[left], w[left], margin[left], node[left] // 2
        else:
            node = np.zeros(len(bins), dtype=np.int64)
        for done in since:
            margin = margin + done.predict(bins)
        features, nodes = bins.shape[1], max(1, 1 << level >> 1)
        place = ((node[:, None] * features + np.arange(features)) * n_bins + bins).ravel()
        gradient = np.rint((margin - y) * w * scale)
        sums = [np.bincount(place, weights=np.repeat(v, features), minlength=nodes * features * n_bins) for v in (gradient, w)]
        return np.stack(sums).reshape(2, nodes, features, n_bins).astype(np.int64)

    return part


def best_splits(sums: np.ndarray, scale: float, settings: BoostingSettings):
    """(feature, bin, left and right sums) per node; a node without a gain keeps all rows on its left."""
    g, h = sums[0] / scale, sums[1].astype(float)
    reg = settings.reg_lambda
    whole_g, whole_h = g[:, 0, :].sum(axis=1), h[:, 0, :].sum(axis=1)
    left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    right_g, right_h = whole_g[:, None, None] - left_g, whole_h[:, None, None] - left_h
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g**2 / (left_h + reg) + right_g**2 / (right_h + reg) - (whole_g**2 / (whole_h + reg))[:, None, None]
    allowed = (left_h >= settings.min_child_weight) & (right_h >= settings.min_child_weight)
    gain = np.where(allowed, gain, 0.0).reshape(len(g), -1)
    chosen = gain.argmax(axis=1)
    split = gain[np.arange(len(g)), chosen] > 1e-6
    n_bins = g.shape[2]
    feature = np.where(split, chosen // n_bins, 0)
    at = np.where(split, chosen % n_bins, n_bins - 1)
    pick = np.arange(len(g)), feature, at
    halves = np.stack([left_g[pick], whole_g - left_g[pick]], 1), np.stack([left_h[pick], whole_h - left_h[pick]], 1)
    return feature, at, halves


def grow(state: Rows, since: list[Tree], scale: float, n_bins: int, settings: BoostingSettings) -> Tree:
    """The next tree: one aggregate over all rows per level."""
    inner, reg = (1 << settings.depth) - 1, settings.reg_lambda
    tree = Tree(np.zeros(inner, dtype=np.int64), np.full(inner, n_bins - 1, dtype=np.int64), np.zeros(inner + 1))
    sums = None
    for level in range(settings.depth):
        left = state.reduce(level_sums(tree, level, since, scale, n_bins))
        sums = left if sums is None else np.stack([left, sums - left], axis=2).reshape(2, -1, *left.shape[2:])
        feature, at, (g, h) = best_splits(sums, scale, settings)
        nodes = slice((1 << level) - 1, (2 << level) - 1)
        tree.feature[nodes], tree.bin[nodes] = feature, at
    tree.value = np.where(h.ravel() > 0, -settings.rate * g.ravel() / np.maximum(h.ravel() + reg, 1e-300), 0.0)
    return tree


def boost(rows: Rows, cuts: list[np.ndarray], settings: BoostingSettings) -> tuple[float, list[Tree]]:
    """(first prediction, trees). The first prediction is the mean label."""
    n_bins = 1 + max((len(c) for c in cuts), default=0)
    binned = rows.map(lambda b: (to_bins(b[0], cuts), b[1], b[2]))
    below, high = binned.reduce(lambda b: np.array([-b[1].min(), b[1].max()]), np.maximum).tolist()
    low = -below
    weight = float(binned.reduce(lambda b: np.array([b[2].sum()], dtype=np.int64))[0])
    # Predictions stay between the labels, so no gradient exceeds their span, and no sum 62 bits.
    widest = math.log2(max(high - low, abs(high), abs(low), 1e-300))
    scale = 2.0 ** math.floor(61 - math.log2(max(1.0, weight)) - widest)
    first = binned.reduce(lambda b: np.array([np.rint(b[1] * b[2] * scale).sum(), b[2].sum()]).astype(np.int64))
    base = float(first[0] / scale / first[1])

    trees: list[Tree] = []
    state, held = with_margins(binned, base, trees), isinstance(binned, HeldRows)
    since: list[Tree] = []
    for _ in range(settings.rounds):
        trees.append(grow(state, since, scale, n_bins, settings))
        since = [*since, trees[-1]]
        if held:  # inside one task there is nothing to lose
            state, since = state.map(lambda b: (*b[:3], b[3] + trees[-1].predict(b[0]))), []
        elif len(since) == settings.refresh:
            state.drop()
            state, since = with_margins(binned, base, list(trees)), []
    for used in (state, binned):
        used.drop()
    return base, trees


def with_margins(binned: Rows, base: float, trees: list[Tree]) -> Rows:
    """The blocks with the predictions so far; from the bins and all trees, so a lost block needs no earlier state."""

    def add(block):
        margin = np.full(len(block[1]), base)
        for tree in trees:
            margin = margin + tree.predict(block[0])
        return (*block, margin)

    return binned.map(add)


class HistogramBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    def __init__(self, settings: BoostingSettings = BoostingSettings(), labelCol="label", featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self.settings = settings
        self._set(labelCol=labelCol, featuresCol=featuresCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> HistogramBoostingModel:
        cuts = feature_cuts(dataset, self.getFeaturesCol(), self.settings.max_bins)
        blocks = training_blocks(dataset, self.getFeaturesCol(), self.getLabelCol())
        try:
            settings = self.settings
            base, trees = run_on(blocks, lambda rows: boost(rows, cuts, settings))
        finally:
            blocks.unpersist()
        values = {
            "base": base,
            "cuts": [c.tolist() for c in cuts],
            **{n: [getattr(t, n).tolist() for t in trees] for n in ("feature", "bin", "value")},
        }
        return HistogramBoostingModel(values, self.getFeaturesCol(), self.getPredictionCol())


class HistogramBoostingModel(ArrayModel):
    def trees(self) -> list[Tree]:
        parts = zip(*(self.values[n] for n in ("feature", "bin", "value")))
        return [Tree(*(np.array(p) for p in tree)) for tree in parts]

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, [np.array(c, dtype=float) for c in self.values["cuts"]])
        out = np.full(len(x), self.values["base"])
        for tree in self.trees():
            out += tree.predict(bins)
        return out
