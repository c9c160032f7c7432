"""Table registry: explicit schemas, natural keys, foreign keys and physical layout.

Parquet enforces none of the constraints; ``operators.constraints`` checks them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS, TS_NTZ = T.DateType(), T.TimestampType(), T.TimestampNTZType()
PRICE, MONEY, TOTAL, MEDIAN = T.DecimalType(18, 4), T.DecimalType(18, 2), T.DecimalType(28, 2), T.DecimalType(20, 5)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# One row per log line; line_no is the position in the log and decides what "first" means.
TRANSACTIONS = struct(
    invoice_no=S,
    stock_code=S,
    description=S,
    quantity=I,
    invoice_date=TS_NTZ,
    unit_price=PRICE,
    customer_id=L,
    country=S,
    line_no=L,
)


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str], ...] = ()
    not_null: tuple[str, ...] = ()
    defaults: dict[str, Any] = field(default_factory=dict)
    # Date column whose month is the partition: loads rewrite the touched months, scans by date prune.
    month_of: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


STORE_FK = ("store_id", "stores")
PRODUCT_FK = ("stock_code", "products")

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "stores",
            struct(
                store_id=S, name=S, region=S, country=S, lat=D, lon=D, sqft=I, opening_date=DATE, is_synthetic=B
            ),
            keys=("store_id",),
            not_null=("store_id", "name", "is_synthetic"),
            defaults={"is_synthetic": True},
        ),
        Table(
            "products",
            struct(stock_code=S, description=S, reference_unit_price=MEDIAN),
            keys=("stock_code",),
            not_null=("stock_code",),
        ),
        Table(
            "orders",
            struct(invoice_no=S, store_id=S, order_date=TS_NTZ, customer_id=S, country=S),
            keys=("invoice_no",),
            foreign_keys=(STORE_FK,),
            not_null=("invoice_no", "store_id", "order_date"),
            month_of="order_date",
        ),
        Table(
            "order_items",
            struct(
                invoice_no=S, stock_code=S, store_id=S, quantity=L, unit_price=PRICE, revenue=MONEY, order_date=DATE
            ),
            keys=("invoice_no", "stock_code"),
            foreign_keys=(("invoice_no", "orders"), PRODUCT_FK, STORE_FK),
            not_null=("invoice_no", "stock_code", "store_id", "quantity", "unit_price", "revenue", "order_date"),
            month_of="order_date",
        ),
        Table(
            "inventory_snapshots",
            struct(
                store_id=S,
                stock_code=S,
                snapshot_date=DATE,
                units_demanded=L,
                stock_on_hand=L,
                restocked=B,
                is_synthetic=B,
            ),
            keys=("store_id", "stock_code", "snapshot_date"),
            foreign_keys=(STORE_FK, PRODUCT_FK),
            not_null=("store_id", "stock_code", "snapshot_date", "units_demanded", "stock_on_hand", "restocked"),
            defaults={"restocked": False, "is_synthetic": True},
            month_of="snapshot_date",
        ),
        Table(
            "store_daily_metrics",
            struct(store_id=S, metric_date=DATE, revenue=TOTAL, orders_count=L, units_sold=L),
            keys=("store_id", "metric_date"),
            foreign_keys=(STORE_FK,),
            not_null=("store_id", "metric_date"),
            month_of="metric_date",
        ),
        Table(
            "inventory_analysis",
            struct(
                store_id=S,
                stock_code=S,
                avg_daily_demand=D,
                avg_stock_on_hand=D,
                days_of_supply=D,
                stockout_days=L,
                turnover_ratio=D,
                computed_at=TS,
            ),
            keys=("store_id", "stock_code"),
            foreign_keys=(STORE_FK, PRODUCT_FK),
            not_null=("store_id", "stock_code", "computed_at"),
        ),
        Table(
            "store_profitability",
            struct(
                store_id=S,
                month=DATE,
                revenue=TOTAL,
                cogs_estimate=TOTAL,
                opex_estimate=TOTAL,
                profit_estimate=TOTAL,
                roi_pct=D,
                computed_at=TS,
            ),
            keys=("store_id", "month"),
            foreign_keys=(STORE_FK,),
            not_null=("store_id", "month", "computed_at"),
        ),
        Table(
            "cross_store_correlation",
            struct(store_id_a=S, store_id_b=S, weekly_revenue_correlation=D, computed_at=TS),
            keys=("store_id_a", "store_id_b"),
            foreign_keys=(("store_id_a", "stores"), ("store_id_b", "stores")),
            not_null=("store_id_a", "store_id_b", "computed_at"),
        ),
        Table(
            "model_evaluation",
            struct(model_name=S, mae=D, rmse=D, computed_at=TS),
            keys=("model_name",),
            not_null=("model_name", "mae", "rmse", "computed_at"),
        ),
        Table(
            "demand_forecast_predictions",
            struct(
                store_id=S,
                stock_code=S,
                snapshot_date=DATE,
                model_name=S,
                predicted_demand=D,
                actual_demand=L,
                computed_at=TS,
            ),
            keys=("store_id", "stock_code", "snapshot_date", "model_name"),
            foreign_keys=(STORE_FK, PRODUCT_FK),
            not_null=("store_id", "stock_code", "snapshot_date", "model_name", "predicted_demand", "actual_demand"),
            month_of="snapshot_date",
        ),
        Table(
            "reorder_policy_comparison",
            struct(
                store_id=S, stock_code=S, policy_name=S, stockout_days=L, avg_stock_on_hand=D, computed_at=TS
            ),
            keys=("store_id", "stock_code", "policy_name"),
            foreign_keys=(STORE_FK, PRODUCT_FK),
            not_null=("store_id", "stock_code", "policy_name", "stockout_days", "avg_stock_on_hand"),
        ),
        Table(
            "automl_leaderboard",
            struct(
                model_id=S,
                algorithm=S,
                rank=I,
                is_leader=B,
                auc=D,
                logloss=D,
                aucpr=D,
                mean_per_class_error=D,
                mae=D,
                rmse=D,
                mse=D,
                rmsle=D,
                mean_residual_deviance=D,
                target_column=S,
                project_name=S,
                trained_at=TS,
            ),
            keys=("model_id",),
            not_null=("model_id", "algorithm", "rank", "is_leader", "target_column", "project_name", "trained_at"),
            defaults={"is_leader": False},
        ),
    )
}
