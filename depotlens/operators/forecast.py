"""Training, scoring and comparing demand forecasts on a time split."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from depotlens.config import EngineConfig
from depotlens.operators.boosting import BoostingSettings, HistogramBoosting
from depotlens.operators.neural import NetworkSettings, NeuralRegressor
from depotlens.operators.panel import PAIR
from depotlens.session import ensure_checkpoint_dir

TARGET = "units_demanded"
PREDICTION = "predicted_demand"


def feature_stages(cfg: EngineConfig) -> list[Estimator]:
    """Numeric features plus one-hot categories fitted on the training rows; an unseen category is all zeros."""
    names = list(cfg.categorical_features)
    indexed, encoded = [f"{c}_index" for c in names], [f"{c}_vector" for c in names]
    return [
        StringIndexer(inputCols=names, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*cfg.numeric_features, *encoded], outputCol="features"),
    ]


def boosted_trees(cfg: EngineConfig) -> HistogramBoosting:
    settings = BoostingSettings(rounds=cfg.trees, depth=cfg.tree_depth, rate=cfg.learning_rate)
    return HistogramBoosting(settings, labelCol=TARGET, featuresCol="features")


def train_forecast(train: DataFrame, cfg: EngineConfig, regressor: Estimator | None = None) -> PipelineModel:
    ensure_checkpoint_dir(train.sparkSession)  # fits keep their blocks of rows there
    columns = [*cfg.numeric_features, *cfg.categorical_features, TARGET]
    rows = train.select(*columns).persist()  # every fitting pass reads the same rows
    try:
        if rows.isEmpty():
            raise ValueError("no training rows: no pair is dense enough before the test window")
        return Pipeline(stages=[*feature_stages(cfg), regressor or boosted_trees(cfg)]).fit(rows)
    finally:
        rows.unpersist()


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows with a prediction that is never negative."""
    scored = model.transform(rows).withColumn(PREDICTION, F.greatest("prediction", F.lit(0.0)))
    return scored.select(*rows.columns, PREDICTION)


def stack_predictions(scored: DataFrame, forecasts: Mapping[str, str]) -> DataFrame:
    """One row per test row and model; ``forecasts`` maps model name to prediction column. One pass, no self-union."""
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("model_name"), F.col(column).cast("double").alias(PREDICTION))
            for name, column in forecasts.items()
        )
    )
    return scored.select(*PAIR, "snapshot_date", F.explode(entries).alias("p"), TARGET).select(
        *PAIR, "snapshot_date", "p.model_name", f"p.{PREDICTION}", F.col(TARGET).alias("actual_demand")
    )


def error_metrics(actual: Column, predicted: Column) -> dict[str, Column]:
    gap = actual.cast("double") - predicted
    log_gap = F.log1p(actual.cast("double")) - F.log1p(predicted)
    return {
        "mae": F.avg(F.abs(gap)),
        "rmse": F.sqrt(F.avg(gap * gap)),
        "mse": F.avg(gap * gap),
        "rmsle": F.sqrt(F.avg(log_gap * log_gap)),
    }


def evaluate_forecast(predictions: DataFrame) -> DataFrame:
    """MAE and RMSE of every model in one aggregate."""
    metrics = error_metrics(F.col("actual_demand"), F.col(PREDICTION))
    return predictions.groupBy("model_name").agg(metrics["mae"].alias("mae"), metrics["rmse"].alias("rmse"))


def run_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: train rows, test rows and dense pairs."""
    per_pair = (
        train.select(*PAIR, F.lit(1).alias("t"))
        .unionByName(test.select(*PAIR, F.lit(0).alias("t")))
        .groupBy(*PAIR)
        .agg(F.sum("t").alias("train"), F.sum(1 - F.col("t")).alias("test"))
    )
    return per_pair.agg(
        F.coalesce(F.sum("train"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("test"), F.lit(0)).alias("test_rows"),
        F.count("*").alias("dense_pairs"),
    )


def busiest_pair_series(scored: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Actual and predicted demand of the pair with the most test-window demand, first key on ties."""
    busiest = (
        scored.groupBy(*PAIR)
        .agg(F.sum(TARGET).alias("total"))
        .orderBy(F.desc("total"), *PAIR)
        .limit(1)
        .select(*PAIR)
    )
    return scored.join(busiest, list(PAIR), "left_semi")


# -- model search ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    model_id: str
    algorithm: str
    regressor: Estimator


def default_candidates(cfg: EngineConfig) -> list[Candidate]:
    columns = {"labelCol": TARGET, "featuresCol": "features"}
    return [
        Candidate("gbt_1", "GBM", boosted_trees(cfg)),
        Candidate("nn_1", "DeepLearning", NeuralRegressor(NetworkSettings(seed=cfg.seed), **columns)),
        Candidate(
            "drf_1", "DRF", RandomForestRegressor(numTrees=50, maxDepth=10, seed=cfg.seed, **columns)
        ),
        Candidate("glm_1", "GLM", GeneralizedLinearRegression(family="gaussian", regParam=0.1, **columns)),
    ]


@dataclass(frozen=True)
class SearchResult:
    leaderboard: DataFrame
    leader_id: str
    models: dict[str, PipelineModel]

    @property
    def leader(self) -> PipelineModel:
        return self.models[self.leader_id]

    def save(self, directory: str) -> list[str]:
        """Store every fitted model; of an ensemble, the weights of its members."""
        paths = []
        for model_id, model in self.models.items():
            path = f"{directory}/{model_id}"
            if isinstance(model, PipelineModel):
                model.write().overwrite().save(path)
            elif hasattr(model, "weights"):
                rows = [(name, float(weight)) for name, weight in model.weights.items()]
                board = self.leaderboard.sparkSession.createDataFrame(rows, "model_id string, weight double")
                board.coalesce(1).write.mode("overwrite").json(path)
            else:
                continue
            paths.append(path)
        return paths


def rank_models(scores: DataFrame, sort_metric: str = "mae") -> DataFrame:
    """Rank and leader flag; the board has one row per candidate, so one ordered window is enough."""
    best = Window.orderBy(sort_metric, "model_id")
    return scores.withColumn("rank", F.row_number().over(best)).withColumn("is_leader", F.col("rank") == 1)


def model_search(
    train: DataFrame,
    cfg: EngineConfig,
    run_ts: datetime,
    candidates: list[Candidate] | None = None,
    fold_days: int = 56,
    sort_metric: str = "mae",
    project_name: str = "demand_model_search",
    parallelism: int = 4,
) -> SearchResult:
    """Fit several model families and rank them on the last ``fold_days`` of the training period.

    The fold is a time split, like the held-out split it stands for. The held-out rows are not
    seen; score ``leader`` on them afterwards. ``parallelism`` candidates are fitted side by side: while one
    waits for its last tasks, another uses the executors.
    """
    fold_start: date = cfg.test_start - timedelta(days=fold_days)
    fit_rows = train.where(F.col("snapshot_date") < F.lit(fold_start))
    fold = train.where(F.col("snapshot_date") >= F.lit(fold_start)).persist()
    try:
        candidates, models, scores = candidates or default_candidates(cfg), {}, None
        ensure_checkpoint_dir(train.sparkSession)
        run = inheritable_thread_target(train.sparkSession)(lambda c: train_forecast(fit_rows, cfg, c.regressor))
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            fitted = list(pool.map(run, candidates))
        for candidate, model in zip(candidates, fitted):
            models[candidate.model_id] = model
            metrics = error_metrics(F.col(TARGET), F.col(PREDICTION))
            line = predict(model, fold).agg(*(c.alias(n) for n, c in metrics.items()))
            line = line.select(
                F.lit(candidate.model_id).alias("model_id"), F.lit(candidate.algorithm).alias("algorithm"), "*"
            )
            scores = line if scores is None else scores.unionByName(line)
        spark = train.sparkSession
        # One small row per candidate; kept as values so the board does not retrain or rescore.
        kept = spark.createDataFrame(scores.collect(), scores.schema)
    finally:
        fold.unpersist()
    board, leader_id = leaderboard(kept, sort_metric, project_name, run_ts)
    return SearchResult(board, leader_id, models)


def leaderboard(scores: DataFrame, sort_metric: str, project_name: str, run_ts: datetime) -> tuple[DataFrame, str]:
    """The board of (model_id, algorithm, metrics) in the table's columns, and the leader's id."""
    nothing = F.lit(None).cast("double")
    ranked = rank_models(scores, sort_metric)
    board = ranked.select(
        "model_id",
        "algorithm",
        "rank",
        "is_leader",
        *(nothing.alias(n) for n in ("auc", "logloss", "aucpr", "mean_per_class_error")),
        "mae",
        "rmse",
        "mse",
        "rmsle",
        F.col("mse").alias("mean_residual_deviance"),
        F.lit(TARGET).alias("target_column"),
        F.lit(project_name).alias("project_name"),
        F.lit(run_ts).cast("timestamp").alias("trained_at"),
    )
    return board, ranked.where("is_leader").first()["model_id"]


def leader_summary(result: SearchResult, test: DataFrame, project_name: str = "demand_model_search") -> DataFrame:
    """The leader's metrics on the held-out rows."""
    scored = predict(result.leader, test)
    metrics = error_metrics(F.col(TARGET), F.col(PREDICTION))
    return scored.agg(metrics["mae"].alias("metric_value"), metrics["rmse"].alias("rmse")).select(
        F.lit(project_name).alias("project_name"),
        F.lit(result.leader_id).alias("leader_model_id"),
        F.lit("mae").alias("metric_name"),
        "metric_value",
        "rmse",
        F.lit(TARGET).alias("target_column"),
    )
