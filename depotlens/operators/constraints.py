"""Key, reference and quality checks that a database would enforce and Parquet does not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.schemas import Table


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Child key values without a parent, with the rows that use them.

    The child is reduced to one row per key before the join, so a key that holds a large share of
    the rows does not land in one task.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_column or column).alias(column))
    return used.join(known, column, "left_anti")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs per column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def orphan_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: items whose invoice has no order header."""
    missing = check_foreign_key(order_items, orders, "invoice_no")
    return missing.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_items"))


def _gate(name: str, failures: Column, note: Column | None = None) -> Column:
    text = note if note is not None else F.lit(None).cast("string")
    return F.struct(F.lit(name).alias("check_name"), failures.cast("bigint").alias("failures"), text.alias("note"))


def quality_report(
    order_items: DataFrame, orders: DataFrame, daily: DataFrame, evaluation: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """One row per gate with its number of failures, plus the model-versus-baseline outcome, which never fails."""
    orphans = orphan_items(order_items, orders).select(
        F.lit("orphan_items").alias("check_name"), F.col("orphan_items").alias("failures")
    )
    negative = daily.agg(F.count_if(F.col("revenue") < 0).alias("failures")).select(
        F.lit("negative_revenue").alias("check_name"), "failures"
    )
    wanted = (cfg.model_name, cfg.baseline_name)
    usable = F.coalesce((F.col("mae") >= 0) & (F.col("rmse") >= 0), F.lit(False))

    def mae_of(name: str):
        return F.max(F.when(F.col("model_name") == name, F.col("mae")))

    models = evaluation.agg(
        *(F.count_if(F.col("model_name") == name).alias(f"n{i}") for i, name in enumerate(wanted)),
        F.count_if(~usable).alias("unusable"),
        mae_of(cfg.model_name).alias("model_mae"),
        mae_of(cfg.baseline_name).alias("baseline_mae"),
    )
    absent = sum((F.col(f"n{i}") == 0).cast("bigint") for i in range(len(wanted)))
    beats = (
        F.when(F.col("model_mae").isNull() | F.col("baseline_mae").isNull(), "not_compared")
        .when(F.col("model_mae") < F.col("baseline_mae"), "model_beats_baseline")
        .otherwise("baseline_not_beaten")
    )
    gates = models.select(
        F.explode(
            F.array(
                _gate("missing_models", absent),
                _gate("invalid_metrics", F.col("unusable")),
                _gate("model_versus_baseline", F.lit(0), beats),
            )
        ).alias("g")
    ).select("g.*")
    counted = orphans.unionByName(negative).withColumn("note", F.lit(None).cast("string")).unionByName(gates)
    status = F.when(F.col("failures") > 0, "failed").otherwise("passed")
    return counted.select("check_name", "failures", F.coalesce("note", status).alias("status"))


def require_rows(**frames: DataFrame) -> None:
    """Stop a job whose inputs are empty."""
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"no rows in {', '.join(empty)}")


def missing_names(required: DataFrame, present: DataFrame, column: str) -> DataFrame:
    """Required names that are not present."""
    return required.select(column).distinct().join(present.select(column), column, "left_anti")


def constraint_report(table: Table, df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Violations of the declared primary key, NOT NULL columns and foreign keys of one table."""

    def line(kind: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(table.name).alias("table_name"), F.lit(kind).alias("constraint_name"), "violations")

    repeated = check_primary_key(df, table.keys).agg(F.count("*").alias("violations"))
    report = line("primary_key", repeated)
    if table.not_null:
        any_null = F.lit(False)
        for column in table.not_null:
            any_null = any_null | F.col(column).isNull()
        nulls = df.agg(F.count_if(any_null).alias("violations"))
        report = report.unionByName(line("not_null", nulls))
    for column, parent in table.foreign_keys:
        if parent in parents:
            key = "store_id" if parent == "stores" else column
            lost = check_foreign_key(df, parents[parent], column, key).agg(
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
            )
            report = report.unionByName(line(f"foreign_key_{column}", lost))
    return report
