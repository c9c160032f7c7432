"""Model search by rolling origins, with a stacked ensemble of the candidates.

The days before the test window end in ``folds`` folds of equal length. For every fold each candidate is fitted on all
days before the fold and predicts the fold's days, so no prediction has seen its own or a later day. These
out-of-fold predictions are stored as one table. The ensemble is the non-negative combination of the candidates with
the least squared error on it; the weights follow from the sums of products of the predictions, one aggregate. On
a fold, the ensemble is scored with the weights of the folds before it (equal ones on the first), so its place on the
leaderboard owes nothing to the days it is scored on either.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators.forecast import (
    PREDICTION, TARGET, Candidate, SearchResult, default_candidates, error_metrics, leaderboard, predict, train_forecast,
)
from depotlens.operators.panel import PAIR
from depotlens.session import materialize

ENSEMBLE = "ensemble_1"


@dataclass(frozen=True)
class ColumnForecast:
    """A candidate that needs no fit: a column of the features is the forecast."""

    column: str

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", F.col(self.column).cast("double"))


@dataclass(frozen=True)
class Ensemble:
    """Fitted candidates and their weights."""

    models: dict[str, PipelineModel | ColumnForecast]
    weights: dict[str, float]

    def transform(self, rows: DataFrame) -> DataFrame:
        used = [name for name, weight in self.weights.items() if weight > 0]
        scored = rows
        for i, name in enumerate(used):
            scored = predict(self.models[name], scored).withColumnRenamed(PREDICTION, f"_member_{i}")
        total = sum((F.lit(self.weights[n]) * F.col(f"_member_{i}") for i, n in enumerate(used)), F.lit(0.0))
        return scored.select(*rows.columns, total.alias("prediction"))


def fold_bounds(cfg: EngineConfig, folds: int, fold_days: int) -> list[tuple[date, date]]:
    """(first day, day after the last) of every fold, earliest first; the last one ends where the test window begins."""
    first = cfg.test_start - timedelta(days=folds * fold_days)
    return [(first + timedelta(days=k * fold_days), first + timedelta(days=(k + 1) * fold_days)) for k in range(folds)]


def fit(candidate: Candidate, rows: DataFrame, cfg: EngineConfig) -> PipelineModel | ColumnForecast:
    if isinstance(candidate.regressor, ColumnForecast):
        return candidate.regressor
    return train_forecast(rows, cfg, candidate.regressor)


def fit_all(jobs: list[tuple[Candidate, DataFrame]], cfg: EngineConfig, parallelism: int) -> list:
    """Fits side by side: while one waits for its last tasks, another uses the executors."""
    if not jobs:
        return []
    run = inheritable_thread_target(jobs[0][1].sparkSession)(lambda job: fit(*job, cfg))
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(run, jobs))


def out_of_fold(
    train: DataFrame, cfg: EngineConfig, candidates: list[Candidate], folds: int = 3, fold_days: int = 28, parallelism: int = 2
) -> DataFrame:
    """(pair, day, fold, demand, one prediction per candidate) of all rows in folds, written."""
    day = F.col("snapshot_date")
    bounds = fold_bounds(cfg, folds, fold_days)
    before = [train.where(day < F.lit(first)) for first, _ in bounds]
    jobs = [(candidate, rows) for rows in before for candidate in candidates]
    models = iter(fit_all(jobs, cfg, parallelism))
    out = None
    for fold, (first, end) in enumerate(bounds):
        scored = train.where((day >= F.lit(first)) & (day < F.lit(end)))
        for candidate in candidates:
            scored = predict(next(models), scored).withColumnRenamed(PREDICTION, candidate.model_id)
        names = [c.model_id for c in candidates]
        part = scored.select(*PAIR, "snapshot_date", F.lit(fold).alias("fold"), TARGET, *names)
        out = part if out is None else out.unionByName(part)
    return materialize(out, "out-of-fold")


def non_negative_least_squares(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """The x >= 0 with the least x'Ax - 2 b'x for sums of products A and b, by the active-set method."""
    n = len(moment)
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    slack = 1e-12 * max(1.0, float(np.abs(moment).max(initial=0.0)))
    for _ in range(10 * n + 10):
        push = moment - gram @ x
        push[free] = -np.inf
        if free.all() or push.max() <= slack:
            break
        free[int(push.argmax())] = True
        while free.any():
            best = np.zeros(n)
            best[free] = np.linalg.lstsq(gram[np.ix_(free, free)], moment[free], rcond=None)[0]
            if (best[free] > 0).all():
                x = best
                break
            falling = free & (best <= 0)
            step = (x[falling] / np.maximum(x[falling] - best[falling], 1e-300)).min()
            x = x + step * (best - x)
            free &= x > slack / max(1.0, float(np.abs(gram).max()))
            x[~free] = 0.0
    return x


def stack_weights(predictions: DataFrame, names: list[str], before_fold: int | None = None) -> dict[str, float]:
    """The candidates' weights from out-of-fold predictions, those of the folds before ``before_fold`` if one is given."""
    rows = predictions if before_fold is None else predictions.where(F.col("fold") < before_fold)
    sums: list[Column] = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    sums += [F.sum(F.col(a) * F.col(TARGET)) for a in names]
    found = rows.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()
    if found["s0"] is None:
        return {name: 1 / len(names) for name in names}
    values, gram = list(found), np.zeros((len(names), len(names)))
    for i in range(len(names)):
        for j in range(i, len(names)):
            gram[i, j] = gram[j, i] = values.pop(0)
    return dict(zip(names, non_negative_least_squares(gram, np.array(values, dtype=float)).tolist()))


def score_candidates(predictions: DataFrame, candidates: list[Candidate], folds: int) -> DataFrame:
    """(model_id, algorithm, metrics) of the candidates and the ensemble over all folds."""
    names = [c.model_id for c in candidates]
    combined = F.lit(None).cast("double")
    for fold in range(folds):
        weights = stack_weights(predictions, names, fold)
        total = sum((F.lit(w) * F.col(n) for n, w in weights.items()), F.lit(0.0))
        combined = F.when(F.col("fold") == fold, total).otherwise(combined)
    entries = [(c.model_id, c.algorithm, F.col(c.model_id)) for c in candidates]
    entries.append((ENSEMBLE, "StackedEnsemble", F.greatest(combined, F.lit(0.0))))
    stacked = predictions.select(
        TARGET,
        F.explode(F.array(*(F.struct(F.lit(n).alias("model_id"), F.lit(a).alias("algorithm"), p.cast("double").alias("p")) for n, a, p in entries))).alias("e"),
    ).select(TARGET, "e.*")
    metrics = error_metrics(F.col(TARGET), F.col("p"))
    return stacked.groupBy("model_id", "algorithm").agg(*(c.alias(n) for n, c in metrics.items()))


def rolling_search(
    train: DataFrame,
    cfg: EngineConfig,
    run_ts: datetime,
    candidates: list[Candidate] | None = None,
    folds: int = 3,
    fold_days: int = 28,
    parallelism: int = 2,
    sort_metric: str = "mae",
    project_name: str = "demand_model_search",
) -> SearchResult:
    """The leaderboard over out-of-fold predictions, and every candidate and the ensemble fitted on all training days."""
    candidates = candidates or default_candidates(cfg)
    predictions = out_of_fold(train, cfg, candidates, folds, fold_days, parallelism)
    scores = score_candidates(predictions, candidates, folds)
    # One small row per candidate; kept as values so the board does not score again.
    kept = train.sparkSession.createDataFrame(scores.collect(), scores.schema)
    board, leader_id = leaderboard(kept, sort_metric, project_name, run_ts)
    fitted = fit_all([(c, train) for c in candidates], cfg, parallelism)
    models = {c.model_id: model for c, model in zip(candidates, fitted)}
    ensemble = Ensemble(dict(models), stack_weights(predictions, list(models)))
    return SearchResult(board, leader_id, {**models, ENSEMBLE: ensemble})
