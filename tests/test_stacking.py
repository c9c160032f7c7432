import random
from datetime import datetime, timedelta, timezone
from itertools import combinations

import numpy as np
import pytest
from frames import day, panel
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators import features, forecast, stacking

CFG = EngineConfig(
    test_start=day(100),
    trees=4,
    numeric_features=("lag_1", "lag_7", "rolling_mean_7", "rolling_std_7", "day_of_week"),
)
def line():
    return GeneralizedLinearRegression(labelCol="units_demanded", featuresCol="features")


@pytest.fixture(scope="module")
def train(spark):
    draw = random.Random(2)
    series = {(s, p): [draw.randrange(0, 30) + 40 * (i % 7 == 0) for i in range(110)] for s in ("LON", "MAN") for p in "AB"}
    return features.train_rows(features.demand_features(panel(spark, series), CFG), CFG).cache()


def candidates():
    return [
        forecast.Candidate("naive", "Baseline", stacking.ColumnForecast("seasonal_naive_pred")),
        forecast.Candidate("line", "GLM", line()),
        forecast.Candidate("gbt", "GBM", forecast.boosted_trees(CFG)),
    ]


def test_no_fold_sees_its_own_or_a_later_day(train, monkeypatch):
    seen = []
    fitted = stacking.fit
    monkeypatch.setattr(stacking, "fit", lambda c, rows, cfg: (seen.append((c.model_id, rows.agg(F.max("snapshot_date")).first()[0])), fitted(c, rows, cfg))[1])
    found = stacking.out_of_fold(train, CFG, candidates(), folds=2, fold_days=14)
    bounds = stacking.fold_bounds(CFG, 2, 14)
    assert bounds == [(day(72), day(86)), (day(86), day(100))]
    assert sorted(seen) == sorted((c.model_id, first - timedelta(days=1)) for first, _ in bounds for c in candidates())
    ranges = {r["fold"]: (r["a"], r["b"], r["n"]) for r in found.groupBy("fold").agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b"), F.count("*").alias("n")).collect()}
    assert ranges == {0: (day(72), day(85), 4 * 14), 1: (day(86), day(99), 4 * 14)}
    # The predictions are those of a model fitted on the days before alone.
    model = forecast.train_forecast(train.where(F.col("snapshot_date") < F.lit(day(86))), CFG, line())
    alone = forecast.predict(model, train.where(F.col("snapshot_date") >= F.lit(day(86))))
    joined = found.where("fold = 1").join(alone, ["store_id", "stock_code", "snapshot_date"])
    assert joined.where(F.abs(F.col("line") - F.col("predicted_demand")) > 1e-9).isEmpty() and joined.count() == 56


@pytest.mark.parametrize("seed", range(30))
def test_weights_equal_the_best_of_all_supports(seed):
    rng = np.random.default_rng(seed)
    n = 1 + seed % 5
    x = rng.normal(size=(40, n)) @ rng.normal(size=(n, n))
    if seed % 4 == 0 and n > 1:
        x[:, 1] = x[:, 0]  # two equal candidates
    y = x @ rng.normal(size=n) + rng.normal(size=40)
    got = stacking.non_negative_least_squares(x.T @ x, x.T @ y)
    best = (y**2).sum()
    for k in range(1, n + 1):
        for support in map(list, combinations(range(n), k)):
            w = np.linalg.lstsq(x[:, support], y, rcond=None)[0]
            if (w >= 0).all():
                best = min(best, ((y - x[:, support] @ w) ** 2).sum())
    assert (got >= 0).all() and ((y - x @ got) ** 2).sum() == pytest.approx(best, rel=1e-9)


def test_weights_from_rows(spark, train):
    found = stacking.out_of_fold(train, CFG, candidates()[:2], folds=2, fold_days=14)
    rows = np.array([[r["naive"], r["line"], r["units_demanded"], r["fold"]] for r in found.collect()], dtype=float)
    for before, part in ((None, rows), (1, rows[rows[:, 3] < 1])):
        want = stacking.non_negative_least_squares(part[:, :2].T @ part[:, :2], part[:, :2].T @ part[:, 2])
        assert list(stacking.stack_weights(found, ["naive", "line"], before).values()) == pytest.approx(want.tolist(), rel=1e-9)
    assert stacking.stack_weights(found, ["naive", "line"], 0) == {"naive": 0.5, "line": 0.5}


def test_search_ranks_and_stores_the_ensemble(train, tmp_path):
    run_ts = datetime(2011, 12, 10, tzinfo=timezone.utc)
    result = stacking.rolling_search(train, CFG, run_ts, candidates(), folds=2, fold_days=14)
    board = result.leaderboard.orderBy("rank").collect()
    assert {r["model_id"] for r in board} == {"naive", "line", "gbt", "ensemble_1"} and [r["rank"] for r in board] == [1, 2, 3, 4]
    assert [r["mae"] for r in board] == sorted(r["mae"] for r in board) and board[0]["model_id"] == result.leader_id
    ensemble = result.models["ensemble_1"]
    scored = forecast.predict(ensemble, train)
    parts = {n: {tuple(r[:3]): r["predicted_demand"] for r in forecast.predict(m, train).select("store_id", "stock_code", "snapshot_date", "predicted_demand").collect()} for n, m in ensemble.models.items()}
    for r in scored.limit(50).collect():
        key = (r["store_id"], r["stock_code"], r["snapshot_date"])
        assert r["predicted_demand"] == pytest.approx(sum(w * parts[n][key] for n, w in ensemble.weights.items()))
    paths = result.save(str(tmp_path))
    assert {p.rsplit("/", 1)[1] for p in paths} == {"line", "gbt", "ensemble_1"}
