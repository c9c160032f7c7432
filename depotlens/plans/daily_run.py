"""The batch run: from the log to loaded tables, marts, forecast, policies, views and checks.

One Spark application. Frames that several steps read are written once to the run's work folder,
so a lost executor costs a re-read and not the run; every load is an upsert, so a repeated run for
the same data leaves the same tables.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators import conform, constraints, features, forecast, marts, panel, policy, reporting, stacking
from depotlens.operators.cleaning import clean_transactions, route_orders
from depotlens.operators.validation import VIOLATIONS, ValidationReport, validate_transactions
from depotlens.schemas import TABLES
from depotlens.session import build_session, drop_materialized
from depotlens.sources.transactions import (
    DECLARED, export_csv, export_json, land_raw, load_checked, load_transactions, stores_table,
)
from depotlens.sources.upsert import TableStore

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    validation: ValidationReport
    loaded: dict[str, int]
    mart_rows: dict[str, int]
    metrics: dict[str, dict[str, float]]
    split: dict[str, int]
    policies: dict[str, dict[str, float]]
    quality: dict[str, str]


class DailyRun:
    def __init__(self, spark: SparkSession, root: str, cfg: EngineConfig, run_ts: datetime | None = None):
        self.spark, self.cfg = spark, cfg
        self.run_ts = run_ts or datetime.now(timezone.utc)
        self.store = TableStore(spark, root)
        self.work = f"{self.store.root}/work/{self.run_ts:%Y%m%dT%H%M%SZ}"
        self.loaded: dict[str, int] = {}

    def _written(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.work}/{name}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _load(self, name: str, df: DataFrame, written: bool = False) -> None:
        table = TABLES[name]
        if "computed_at" in table.columns:
            df = df.withColumn("computed_at", F.lit(self.run_ts).cast("timestamp"))
        batch = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema if f.name in df.columns))
        # Every batch of a run is grouped by its key.
        self.loaded[name] = self.store.upsert(
            table, batch, on_duplicate="unique", run_ts=self.run_ts, written=written
        )
        self.store.drop_old_versions(table)

    def _table(self, name: str) -> DataFrame:
        return self.store.read(TABLES[name])

    def validate(self, transactions: DataFrame) -> tuple[DataFrame, ValidationReport]:
        """Clean, route and mark the log in one pass; valid and quarantined rows are two partitions of one table."""
        checked = validate_transactions(route_orders(clean_transactions(transactions), self.cfg), self.cfg)
        if checked.errors:
            return transactions, ValidationReport(transactions.count(), 0, checked.errors)
        marked = checked.marked.withColumn("is_valid", F.size(VIOLATIONS) == 0)
        # The report is counted while the rows are written, not by reading them again.
        seen = Observation("validation")
        rules = [F.count_if(F.array_contains(VIOLATIONS, name)).alias(f"rule_{i}") for i, name in enumerate(checked.conditions)]
        counted = marked.observe(seen, F.count("*").alias("total"), F.count_if("is_valid").alias("valid"), *rules)
        written = self._written(counted, "validated", ("is_valid",))
        found = seen.get
        broken = {name: found[f"rule_{i}"] for i, name in enumerate(checked.conditions) if found[f"rule_{i}"]}
        report = ValidationReport(found["total"], found["valid"], (), broken)
        return written.where("is_valid").drop("is_valid", VIOLATIONS), report

    def conform(self, lines: DataFrame) -> DataFrame:
        """Load stores, products, orders and items; returns the items of this run.

        Items are grouped by invoice, product and store but keyed without the store, so only an
        invoice that was split over stores can repeat a key, and only those are checked.
        """
        self._load("stores", stores_table(self.spark, self.cfg))
        self._load("products", conform.build_products(lines))
        headers = self._written(conform.build_orders(lines, mark_split=True), "orders")
        self._load("orders", headers, written=True)
        items = self._written(conform.build_order_items(lines, self.cfg), "order_items")
        split = headers.where("is_split").select("invoice_no")
        if not split.isEmpty():
            suspects = items.join(split, "invoice_no", "left_semi")
            repeated = constraints.check_primary_key(suspects, TABLES["order_items"].keys)
            if not repeated.isEmpty():
                raise ValueError(f"one product of one invoice at two stores, e.g. {repeated.first().asDict()}")
        self._load("order_items", items, written=True)
        return items

    def marts(self) -> dict[str, int]:
        """Compute and load the four marts; returns the rows each table holds afterwards."""
        cfg, stores = self.cfg, self._table("stores")
        self._load("store_daily_metrics", marts.store_daily_metrics(self._table("order_items")))
        self._load("inventory_analysis", marts.inventory_analysis(self._table("inventory_snapshots"), cfg))
        daily = self._table("store_daily_metrics")
        self._load("store_profitability", marts.store_profitability(daily, stores, cfg))
        self._load("cross_store_correlation", marts.cross_store_correlation(daily))
        names = ("store_daily_metrics", "inventory_analysis", "store_profitability", "cross_store_correlation")
        return {name: self._table(name).count() for name in names}

    def forecast(self) -> dict[str, int]:
        cfg, snapshots = self.cfg, self._table("inventory_snapshots")
        frame = features.training_frame(snapshots, self._table("products"), cfg)
        featured = self._written(features.demand_features(frame, cfg), "demand_features")
        train, test = features.train_rows(featured, cfg), features.test_rows(featured, cfg)
        model = forecast.train_forecast(train, cfg)
        scored = self._written(forecast.predict(model, test), "scored")
        names = {cfg.model_name: forecast.PREDICTION, cfg.baseline_name: "seasonal_naive_pred"}
        predictions = forecast.stack_predictions(scored, names)
        self._load("model_evaluation", forecast.evaluate_forecast(predictions))
        self._load("demand_forecast_predictions", predictions)
        eve = cfg.test_start - timedelta(days=1)
        opening = policy.opening_stock(self.store.read(TABLES["inventory_snapshots"], eve, eve), cfg)
        self._load("reorder_policy_comparison", policy.compare_policies(scored, forecast.PREDICTION, opening, cfg))
        return forecast.run_summary(train, test).first().asDict()

    def search(self) -> DataFrame:
        """Search by rolling origins over the features of this run: leaderboard, saved models, the leader's summary."""
        featured = self.spark.read.parquet(f"{self.work}/demand_features")
        train, test = features.train_rows(featured, self.cfg), features.test_rows(featured, self.cfg)
        cfg = self.cfg
        result = stacking.rolling_search(train, cfg, self.run_ts, folds=cfg.search_folds, fold_days=cfg.search_fold_days)
        self._load("automl_leaderboard", result.leaderboard)
        result.save(f"{self.work}/models")
        export_csv(test, f"{self.work}/test_frame")
        summary = forecast.leader_summary(result, test)
        export_json(summary, f"{self.work}/leader_summary")
        return summary

    def views(self) -> dict[str, DataFrame]:
        stores, products = self._table("stores"), self._table("products")
        found = {
            "sales_summary": reporting.sales_summary(self._table("store_daily_metrics"), stores),
            "inventory_summary": reporting.inventory_summary(self._table("inventory_analysis"), stores, products),
            "store_performance": reporting.store_performance(self._table("store_profitability"), stores),
        }
        for name, df in found.items():
            df.createOrReplaceTempView(name)
        return found

    def check(self) -> dict[str, str]:
        report = constraints.quality_report(
            self._table("order_items"),
            self._table("orders"),
            self._table("store_daily_metrics"),
            self._table("model_evaluation"),
            self.cfg,
        ).collect()
        failed = [r for r in report if r["failures"]]
        if failed:
            raise ValueError(f"quality checks failed: {[(r['check_name'], r['failures']) for r in failed]}")
        outcome = {r["check_name"]: r["status"] for r in report}
        if outcome["model_versus_baseline"] != "model_beats_baseline":
            log.warning("the seasonal baseline is the better forecaster on this run")
        return outcome


def run_pipeline(
    spark: SparkSession,
    transactions: DataFrame,
    root: str,
    cfg: EngineConfig | None = None,
    run_ts: datetime | None = None,
    with_search: bool = False,
) -> RunResult:
    run = DailyRun(spark, root, cfg or EngineConfig(), run_ts)
    lines, report = run.validate(transactions)
    report.raise_if_invalid(run.cfg.max_invalid_ratio)
    constraints.require_rows(transactions=lines)
    items = run.conform(lines)
    demand = run._written(panel.daily_demand(items), "daily_demand")
    run._load("inventory_snapshots", panel.inventory_snapshots(demand, run.cfg))
    mart_rows = run.marts()
    split = run.forecast()
    if with_search:
        run.search()
    run.views()
    quality = run.check()
    metrics = {r["model_name"]: {"mae": r["mae"], "rmse": r["rmse"]} for r in run._table("model_evaluation").collect()}
    totals = policy.policy_totals(run._table("reorder_policy_comparison"), run.cfg).collect()
    policies = {r["policy_name"]: {k: v for k, v in r.asDict().items() if k != "policy_name"} for r in totals}
    return RunResult(report, run.loaded, mart_rows, metrics, split, policies, quality)


def main() -> None:
    parser = argparse.ArgumentParser(description="Run the daily batch over a transaction log.")
    parser.add_argument("--log", required=True, help="path of the transaction log")
    parser.add_argument("--format", default="parquet", choices=("parquet", "orc", *DECLARED))
    parser.add_argument("--root", required=True, help="folder of the engine's tables")
    parser.add_argument("--search", action="store_true", help="also run the model search")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = build_session("depotlens-daily-run")
    run_ts = datetime.now(timezone.utc)
    if args.format in DECLARED:
        transactions, malformed = load_checked(spark, args.log, args.format)
        land_raw(malformed, args.root, run_ts, "malformed")
    else:
        transactions = load_transactions(spark, args.log, args.format)
    result = run_pipeline(spark, transactions, args.root, run_ts=run_ts, with_search=args.search)
    log.info("loaded %s", result.loaded)
    log.info("metrics %s, quality %s", result.metrics, result.quality)
    drop_materialized(spark)


if __name__ == "__main__":
    main()
