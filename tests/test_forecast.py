import random
import threading
from datetime import date, datetime, timezone

import pytest
from frames import day, panel
from pyspark.ml import Pipeline
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators import constraints, features, forecast

CFG = EngineConfig(
    test_start=day(70),
    trees=3,
    numeric_features=("lag_1", "lag_7", "rolling_mean_7", "rolling_std_7", "day_of_week"),
)


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(1)
    series = {(s, p): [draw.randrange(0, 30) + 40 * (i % 7 == 0) for i in range(90)] for s in ("LON", "MAN") for p in "AB"}
    return features.demand_features(panel(spark, series), CFG).cache()


def test_split_is_by_time(rows):
    train, test = features.train_rows(rows, CFG), features.test_rows(rows, CFG)
    assert train.agg(F.max("snapshot_date")).first()[0] == day(69)
    assert test.agg(F.min("snapshot_date")).first()[0] == day(70)
    summary = forecast.run_summary(train, test).first()
    assert (summary["train_rows"], summary["test_rows"], summary["dense_pairs"]) == (4 * 63, 4 * 20, 4)


def test_an_unseen_store_is_all_zeros(spark, rows):
    fitted = Pipeline(stages=forecast.feature_stages(CFG)).fit(features.train_rows(rows, CFG))
    unseen = rows.limit(1).withColumn("store_id", F.lit("NEW"))
    vector = fitted.transform(unseen).first()["features"].toArray()
    assert len(vector) == 5 + 2 and list(vector[5:]) == [0.0, 0.0]


def test_boosted_trees_beat_zero_and_never_predict_below_it(rows):
    model = forecast.train_forecast(features.train_rows(rows, CFG), CFG)
    scored = forecast.predict(model, features.test_rows(rows, CFG))
    assert scored.where(F.col("predicted_demand") < 0).count() == 0
    names = {CFG.model_name: "predicted_demand", CFG.baseline_name: "seasonal_naive_pred"}
    predictions = forecast.stack_predictions(scored, names)
    assert predictions.count() == 2 * 80
    got = {r["model_name"]: (r["mae"], r["rmse"]) for r in forecast.evaluate_forecast(predictions).collect()}
    pairs = scored.select("units_demanded", "seasonal_naive_pred").collect()
    errors = [abs(a - b) for a, b in pairs]
    assert got[CFG.baseline_name][0] == pytest.approx(sum(errors) / len(errors))
    assert got[CFG.baseline_name][1] == pytest.approx((sum(e * e for e in errors) / len(errors)) ** 0.5)


def test_predictions_are_clipped(rows):
    falling = LinearRegression(labelCol="minus", featuresCol="features")
    train = features.train_rows(rows, CFG)
    below = train.withColumn("minus", -F.col("units_demanded") - 100.0)
    pipe = Pipeline(stages=[*forecast.feature_stages(CFG), falling]).fit(below)
    assert forecast.predict(pipe, train).agg(F.max("predicted_demand")).first()[0] == 0.0


def test_no_training_rows_is_an_error(rows):
    with pytest.raises(ValueError, match="no training rows"):
        forecast.train_forecast(rows.limit(0), CFG)


def test_model_search_ranks_and_flags_one_leader(rows, tmp_path):
    flat = {"labelCol": "units_demanded", "featuresCol": "features"}
    candidates = [
        forecast.Candidate("glm", "GLM", GeneralizedLinearRegression(**flat)),
        forecast.Candidate("gbt", "GBM", forecast.boosted_trees(CFG)),
    ]
    train = features.train_rows(rows, CFG)
    run_ts = datetime(2011, 12, 10, tzinfo=timezone.utc)
    result = forecast.model_search(train, CFG, run_ts, candidates, fold_days=14)
    board = result.leaderboard.orderBy("rank").collect()
    assert [r["rank"] for r in board] == [1, 2] and [r["is_leader"] for r in board] == [True, False]
    assert board[0]["mae"] <= board[1]["mae"] and board[0]["model_id"] == result.leader_id
    assert all(r["auc"] is None and r["mse"] == r["mean_residual_deviance"] for r in board)
    assert len(result.save(str(tmp_path))) == 2 and (tmp_path / "gbt").exists()
    summary = forecast.leader_summary(result, features.test_rows(rows, CFG)).first()
    assert summary["leader_model_id"] == result.leader_id and summary["metric_value"] > 0


def test_rank_ties_go_to_the_lower_id(spark):
    scores = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "model_id string, mae double")
    ranked = {r["model_id"]: r["rank"] for r in forecast.rank_models(scores).collect()}
    assert ranked == {"c": 1, "a": 2, "b": 3}


def test_busiest_pair(rows):
    totals = rows.groupBy("store_id", "stock_code").agg(F.sum("units_demanded").alias("t"))
    totals = totals.orderBy(F.desc("t"), "store_id", "stock_code").first()
    series = forecast.busiest_pair_series(rows, CFG)
    assert {(r[0], r[1]) for r in series.select("store_id", "stock_code").collect()} == {(totals[0], totals[1])}


def evaluation(spark, *models):
    return spark.createDataFrame(list(models), "model_name string, mae double, rmse double")


@pytest.fixture(scope="module")
def loaded(spark):
    items = spark.createDataFrame([("1", 1), ("1", 2), ("2", 1)], "invoice_no string, quantity int")
    orders = spark.createDataFrame([("1",)], "invoice_no string")
    daily = spark.createDataFrame([(1.0,), (-2.0,)], "revenue double")
    return items, orders, daily


def gates(spark, loaded, *models):
    return {r[0]: (r[1], r[2]) for r in constraints.quality_report(*loaded, evaluation(spark, *models), CFG).collect()}


def test_quality_gates(spark, loaded):
    got = gates(spark, loaded, (CFG.model_name, 3.0, 4.0), (CFG.baseline_name, 3.0, 5.0))
    assert got["orphan_items"] == (1, "failed") and got["negative_revenue"] == (1, "failed")
    assert got["missing_models"] == (0, "passed") and got["invalid_metrics"] == (0, "passed")
    assert got["model_versus_baseline"] == (0, "baseline_not_beaten")
    better = gates(spark, loaded, (CFG.model_name, 2.9, 4.0), (CFG.baseline_name, 3.0, 5.0))
    assert better["model_versus_baseline"] == (0, "model_beats_baseline")
    bad = gates(spark, loaded, (CFG.model_name, None, 4.0), ("other", -1.0, 5.0))
    assert bad["missing_models"] == (1, "failed") and bad["invalid_metrics"] == (2, "failed")


def test_key_checks(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", None)], "k string, p string")
    assert [tuple(r) for r in constraints.check_primary_key(df, ["k"]).collect()] == [("1", 2)]
    parent = spark.createDataFrame([("b",)], "p string")
    assert [tuple(r) for r in constraints.check_foreign_key(df, parent, "p").collect()] == [("a", 2)]
    assert constraints.check_not_null(df, ["k", "p"]).first().asDict() == {"k": 0, "p": 1}
    required = spark.createDataFrame([("a",), ("b",)], "p string")
    assert [r[0] for r in constraints.missing_names(required, parent, "p").collect()] == ["a"]


def test_candidates_of_the_search_are_fitted_side_by_side(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)  # breaks if one fit waits for the other's end

    def fitted(rows, cfg, regressor):
        both.wait()
        return regressor

    monkeypatch.setattr(forecast, "train_forecast", fitted)
    monkeypatch.setattr(forecast, "predict", lambda model, rows: rows.withColumn(forecast.PREDICTION, F.lit(float(model))))
    train = spark.createDataFrame([(date(2001, 6, 1), 4), (date(2001, 1, 1), 9)], "snapshot_date date, units_demanded long")
    candidates = [forecast.Candidate(f"m{i}", "x", i) for i in (1, 3)]
    result = forecast.model_search(train, EngineConfig(test_start=date(2001, 6, 7)), datetime(2001, 8, 2), candidates)
    assert result.leader_id == "m3" and result.models == {"m1": 1, "m3": 3}
