"""Reorder policies replayed over the held-out demand, and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators.panel import PAIR


def restock_level(forecast: Column, sigma: Column, cfg: EngineConfig) -> Column:
    """Forecast over the lookahead plus a safety buffer, rounded half to even, never negative."""
    days = float(cfg.lookahead_days)
    buffer = F.lit(cfg.safety_z) * F.coalesce(sigma, F.lit(0.0)) * F.lit(days**0.5)
    level = F.greatest(F.lit(0.0), F.bround(forecast * F.lit(days) + buffer)).cast("bigint")
    return F.least(level, F.lit(cfg.max_restock)) if cfg.max_restock is not None else level


def opening_stock(snapshots: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Stock of every pair on the day before the test window; the date filter reaches the scan."""
    eve = F.date_sub(F.lit(cfg.test_start), 1)
    return snapshots.where(F.col("snapshot_date") == eve).select(*PAIR, F.col("stock_on_hand").alias("opening_stock"))


def _replay(days: Column, opening: Column, refill: str) -> Column:
    """Fold the sorted days of one pair into its final stock, restock days and summed stock."""
    start = F.struct(opening.alias("stock"), F.lit(0).cast("bigint").alias("events"), F.lit(0).cast("bigint").alias("held"))

    def step(state: Column, day: Column) -> Column:
        left = state["stock"] - day["units"]
        stock = F.when(left <= 0, day[refill]).otherwise(left)
        return F.struct(
            stock.alias("stock"),
            (state["events"] + F.when(left <= 0, 1).otherwise(0)).cast("bigint").alias("events"),
            (state["held"] + stock).alias("held"),
        )

    return F.aggregate(days, start, step)


def compare_policies(test: DataFrame, forecast: str, opening: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Restock days and mean stock per pair under the fixed and the forecast policy.

    Both see the same demand and the same trigger. A pair contributes one array entry per day of
    the test window, so the arrays are bounded by the window; both replays read the same array, so
    the two policies cost one shuffle. Catalyst expressions only.
    """
    day = F.struct(
        F.col("snapshot_date").alias("day"),
        F.col("units_demanded").cast("bigint").alias("units"),
        F.lit(cfg.par_level).cast("bigint").alias("fixed"),
        restock_level(F.col(forecast), F.col("rolling_std_7"), cfg).alias("informed"),
    )
    series = (
        test.groupBy(*PAIR)
        .agg(F.array_sort(F.collect_list(day)).alias("days"))
        .join(opening, list(PAIR), "left")
    )
    begin = F.coalesce(F.col("opening_stock"), F.lit(cfg.par_level)).cast("bigint")
    outcomes = F.array(
        F.struct(F.lit(cfg.fixed_policy).alias("policy_name"), _replay(F.col("days"), begin, "fixed").alias("r")),
        F.struct(F.lit(cfg.forecast_policy).alias("policy_name"), _replay(F.col("days"), begin, "informed").alias("r")),
    )
    return series.select(*PAIR, F.size("days").alias("n"), F.explode(outcomes).alias("o")).select(
        *PAIR,
        "o.policy_name",
        F.col("o.r.events").alias("stockout_days"),
        (F.col("o.r.held") / F.col("n")).alias("avg_stock_on_hand"),
    )


def policy_totals(comparison: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Totals and means per policy, the fixed policy first."""
    order = F.array_position(F.array(F.lit(cfg.fixed_policy), F.lit(cfg.forecast_policy)), F.col("policy_name"))
    return (
        comparison.groupBy("policy_name")
        .agg(
            F.sum("stockout_days").alias("total_stockout_days"),
            F.avg("stockout_days").alias("avg_stockout_days"),
            F.avg("avg_stock_on_hand").alias("avg_stock_on_hand"),
        )
        .orderBy(order)
    )


def policy_pivot(comparison: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per pair with the mean stock of each policy and their difference."""
    names = [cfg.fixed_policy, cfg.forecast_policy]
    wide = comparison.groupBy(*PAIR).pivot("policy_name", names).agg(F.first("avg_stock_on_hand"))
    return wide.withColumn("stock_change", F.col(cfg.forecast_policy) - F.col(cfg.fixed_policy))


def policy_change_summary(wide: DataFrame) -> DataFrame:
    """Median change of held stock and the share of pairs that hold less; one input row per top product and store."""
    return wide.agg(
        F.count("*").alias("pairs"),
        F.median("stock_change").alias("median_stock_change"),
        F.count_if(F.col("stock_change") < 0).alias("pairs_lower"),
        F.avg((F.col("stock_change") < 0).cast("int")).alias("share_lower"),
    )


def largest_increases(wide: DataFrame, n: int = 5) -> DataFrame:
    return wide.orderBy(F.desc("stock_change"), *PAIR).limit(n)


def with_stored_forecast(test: DataFrame, predictions: DataFrame, model_name: str) -> DataFrame:
    """Test rows with the stored prediction of one model, joined on pair and day."""
    chosen = predictions.where(F.col("model_name") == model_name).select(*PAIR, "snapshot_date", "predicted_demand")
    return test.join(chosen, [*PAIR, "snapshot_date"])


def restock_distribution(test: DataFrame, forecast: str, cfg: EngineConfig) -> DataFrame:
    """Distribution of the computed restock levels and the share below the fixed par level."""
    level = F.col("level")
    quarters = F.percentile(level, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    found = test.select(restock_level(F.col(forecast), F.col("rolling_std_7"), cfg).alias("level")).agg(
        F.count(level).alias("count"),
        F.avg(level).alias("mean"),
        F.stddev_samp(level).alias("std"),
        F.min(level).alias("min"),
        quarters.alias("q"),
        F.max(level).alias("max"),
        F.avg((level < cfg.par_level).cast("int")).alias("share_below_par"),
    )
    parts = [F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return found.select("count", "mean", "std", "min", *parts, "max", "share_below_par")
