"""Which pairs can be forecast, and the features that describe their days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from depotlens.config import EngineConfig
from depotlens.functions.statistics import mean_of_present
from depotlens.operators.panel import PAIR


def select_dense_pairs(snapshots: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Pairs with demand on enough days, judged on the days before the test window only."""
    return (
        snapshots.where(F.col("snapshot_date") < F.lit(cfg.test_start))
        .groupBy(*PAIR)
        .agg(F.avg((F.col("units_demanded") > 0).cast("int")).alias("density"))
        .where(F.col("density") >= cfg.min_density)
    )


def training_frame(snapshots: DataFrame, products: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The panel rows of the dense pairs with the product's reference price, missing prices filled by the median.

    Prices are attached to the short list of pairs and travel with it, so the panel is joined once.
    The fill value is weighted by panel rows.
    """
    pairs = select_dense_pairs(snapshots, cfg).select(*PAIR)
    prices = products.select("stock_code", F.col("reference_unit_price").cast("double").alias("reference_unit_price"))
    priced = pairs.join(prices, "stock_code", "left")
    frame = snapshots.select(*PAIR, "snapshot_date", "units_demanded", "stock_on_hand").join(priced, list(PAIR))
    per_price = frame.groupBy("reference_unit_price").agg(F.count("*").alias("n"))
    middle = per_price.agg(F.percentile("reference_unit_price", F.lit(0.5), F.col("n"))).scalar()
    return frame.withColumn("reference_unit_price", F.coalesce("reference_unit_price", middle))


def demand_features(frame: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Lags, trailing week statistics, weekday and the seasonal baseline; no row sees its own day.

    All windows share one partitioning and order, so there is one shuffle and one sort. Rows with a
    missing feature are dropped; the seasonal mean skips missing weeks.
    """
    by_day = Window.partitionBy(*PAIR).orderBy("snapshot_date")
    trailing = by_day.rowsBetween(-7, -1)
    units = F.col("units_demanded")
    full_week = F.count(units).over(trailing) == 7
    weeks = [F.lag(units, 7 * k).over(by_day) for k in range(1, cfg.seasonal_weeks + 1)]
    seasonal, present = mean_of_present(weeks)
    featured = frame.withColumns(
        {
            "day_of_week": F.weekday("snapshot_date"),
            "lag_1": F.lag(units, 1).over(by_day),
            "lag_7": F.lag(units, 7).over(by_day),
            "rolling_mean_7": F.when(full_week, F.avg(units).over(trailing)),
            "rolling_std_7": F.when(full_week, F.stddev_samp(units).over(trailing)),
            "seasonal_naive_pred": F.when(present >= cfg.min_seasonal_lags, seasonal),
        }
    )
    return featured.na.drop(subset=[*cfg.numeric_features, "seasonal_naive_pred"])


def train_rows(features: DataFrame, cfg: EngineConfig) -> DataFrame:
    return features.where(F.col("snapshot_date") < F.lit(cfg.test_start))


def test_rows(features: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Rows of the test window: from ``test_start`` on, for ``test_days`` days if that is set.

    A day behind the window would be neither trained on nor tested, so it is an error when the rows are read.
    """
    rows = features.where(F.col("snapshot_date") >= F.lit(cfg.test_start))
    if cfg.test_days is None:
        return rows
    inside = F.col("snapshot_date") < F.date_add(F.lit(cfg.test_start), cfg.test_days)
    late = F.concat(F.lit("a day behind the test window, set test_start or test_days: "), F.col("snapshot_date").cast("string"))
    return rows.where(F.when(inside, F.lit(True)).otherwise(F.raise_error(late).cast("boolean")))
