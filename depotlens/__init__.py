"""Retail fulfilment analytics as Spark DataFrame operators."""

from depotlens.config import EngineConfig, RoutingRule
from depotlens.operators.cleaning import clean_transactions, route_orders
from depotlens.operators.conform import build_order_items, build_orders, build_products
from depotlens.operators.constraints import check_foreign_key, check_not_null, check_primary_key, quality_report
from depotlens.operators.features import demand_features, select_dense_pairs, training_frame
from depotlens.operators.forecast import evaluate_forecast, model_search, predict, train_forecast
from depotlens.operators.marts import (
    cross_store_correlation,
    inventory_analysis,
    store_daily_metrics,
    store_profitability,
)
from depotlens.operators.panel import densify_panel, inventory_snapshots, replay_balance, top_products
from depotlens.operators.policy import compare_policies
from depotlens.operators.reporting import (
    inventory_summary,
    measures,
    sales_summary,
    store_performance,
    weekly_revenue,
)
from depotlens.operators.validation import Rules, validate
from depotlens.plans.daily_run import run_pipeline
from depotlens.sources.transactions import load_transactions, stores_table
from depotlens.sources.upsert import TableStore, merge_upsert

__all__ = [
    "EngineConfig",
    "RoutingRule",
    "Rules",
    "TableStore",
    "build_order_items",
    "build_orders",
    "build_products",
    "check_foreign_key",
    "check_not_null",
    "check_primary_key",
    "clean_transactions",
    "compare_policies",
    "cross_store_correlation",
    "demand_features",
    "densify_panel",
    "evaluate_forecast",
    "inventory_analysis",
    "inventory_snapshots",
    "inventory_summary",
    "load_transactions",
    "measures",
    "merge_upsert",
    "model_search",
    "predict",
    "quality_report",
    "replay_balance",
    "route_orders",
    "run_pipeline",
    "sales_summary",
    "select_dense_pairs",
    "store_daily_metrics",
    "store_performance",
    "store_profitability",
    "stores_table",
    "top_products",
    "train_forecast",
    "training_frame",
    "validate",
    "weekly_revenue",
]
