"""The dense store x product x day panel and the ordered stock replay over it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from depotlens.config import EngineConfig
from depotlens.functions.frames import fill_calendar
from depotlens.operators.stretches import replay_stretches

PAIR = ("store_id", "stock_code")


def daily_demand(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy(*PAIR, F.col("order_date").alias("snapshot_date")).agg(
        F.sum("quantity").alias("units_demanded")
    )


def top_products(demand: DataFrame, cfg: EngineConfig, units: str = "units_demanded") -> DataFrame:
    """The best-selling products, ties by code: one global list, or one list per store."""
    if cfg.top_n_per_store:
        totals = demand.groupBy(*PAIR).agg(F.sum(units).alias("units"))
        best = Window.partitionBy("store_id").orderBy(F.desc("units"), "stock_code")
        ranked = totals.withColumn("_rank", F.row_number().over(best))
        return ranked.where(F.col("_rank") <= cfg.top_n_products).drop("_rank")
    totals = demand.groupBy("stock_code").agg(F.sum(units).alias("units"))
    return totals.orderBy(F.desc("units"), "stock_code").limit(cfg.top_n_products)


def top_demand(demand: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Daily demand of the top products only, ranked over all days or over the days before ``top_as_of``."""
    ranked = demand.where(F.col("snapshot_date") < F.lit(cfg.top_as_of)) if cfg.top_as_of else demand
    best = top_products(ranked, cfg)
    keys = list(PAIR) if cfg.top_n_per_store else ["stock_code"]
    return demand.join(best.select(*keys), keys, "left_semi")


def _filled(demand: DataFrame, **columns: Mapping[str, Column]) -> DataFrame:
    """One row per pair and day between the first and the last day of any pair; missing demand is 0."""
    first = demand.agg(F.min("snapshot_date")).scalar()
    last = demand.agg(F.max("snapshot_date")).scalar()
    partitions = int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fill_calendar(
        demand, PAIR, "snapshot_date", "units_demanded", first=first, last=last, partitions=partitions, **columns
    )


def densify_panel(demand: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Every observed pair on every day between the first and the last day of any pair; missing demand is 0."""
    return _filled(demand)


def _stock_fold() -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The fold as a local function: it travels to the executors by value, so they need no copy of this package."""
    inputs = ["_begins", "_opening", "_demand", "_refill"]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stock = 0
        for batch in batches:
            levels, events = [], []
            for begins, opening, demand, refill in zip(*(batch.column(name).to_pylist() for name in inputs)):
                stock = (opening if begins else stock) - demand
                event = stock <= 0
                if event:
                    stock = refill
                levels.append(stock)
                events.append(event)
            kept = batch.drop_columns(inputs)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(levels, pa.int64()), pa.array(events, pa.bool_())],
                names=[*kept.schema.names, "stock_on_hand", "restocked"],
            )

    return fold


def replay_balance(
    df: DataFrame, keys: Sequence[str], order_by: str, demand: str, opening: Column, restock_to: Column
) -> DataFrame:
    """Replay a stock balance per key and day: subtract the demand, and at or below zero reset to ``restock_to``.

    The overshoot is lost at a reset, so no running sum expresses it. Rows arrive clustered by key
    and sorted by day, and the fold carries one number from row to row across Arrow batches: a
    series is streamed, never held, whatever its length.
    """
    series = Window.partitionBy(*keys).orderBy(order_by)
    ordered = df.withColumns(
        {
            "_begins": F.row_number().over(series) == 1,
            "_opening": opening.cast("bigint"),
            "_demand": F.col(demand).cast("bigint"),
            "_refill": restock_to.cast("bigint"),
        }
    ).sortWithinPartitions(*keys, order_by)
    schema = T.StructType(
        [*df.schema.fields, T.StructField("stock_on_hand", T.LongType()), T.StructField("restocked", T.BooleanType())]
    )
    return ordered.mapInArrow(_stock_fold(), schema)


def demand_panel(demand: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The dense daily demand of the top products, from daily demand per store and product.

    Ranking, calendar bounds and rows all come from ``demand``: a caller with large items writes it first.
    """
    return densify_panel(top_demand(demand, cfg), cfg)


def inventory_snapshots(demand: DataFrame, cfg: EngineConfig, stretches: bool = False) -> DataFrame:
    """The daily stock of the top products at every store that sold them, from daily demand.

    The stock can change only on a day with demand, so the days with demand are replayed and the stock is
    carried over the days between; before a pair's first demand it is the opening stock. That needs opening
    and refill levels above zero, at which a day without demand never restocks. ``stretches`` replays parts of a series
    side by side, for series that are too long for one task each.
    """
    if cfg.starting_stock <= 0 or cfg.par_level <= 0:
        raise ValueError("the opening stock and the par level have to be above zero")
    opening = F.lit(cfg.starting_stock).cast("bigint")
    days = top_demand(demand, cfg)
    if stretches:
        replayed = replay_stretches(days, PAIR, "snapshot_date", "units_demanded", cfg.starting_stock, cfg.par_level)
    else:
        replayed = replay_balance(days, PAIR, "snapshot_date", "units_demanded", opening, F.lit(cfg.par_level))
    panel = _filled(replayed, carried={"stock_on_hand": opening}, own={"restocked": F.lit(False)})
    return panel.withColumn("is_synthetic", F.lit(True))


def panel_overview(snapshots: DataFrame) -> DataFrame:
    """One row: size, range, distinct stores, products and pairs, and the share of days without demand."""
    by_pair = snapshots.groupBy(*PAIR).agg(
        F.count("*").alias("n"),
        F.min("snapshot_date").alias("lo"),
        F.max("snapshot_date").alias("hi"),
        F.count_if(F.col("units_demanded") == 0).alias("zero"),
    )
    return by_pair.agg(
        F.sum("n").alias("total_rows"),
        F.min("lo").alias("min_date"),
        F.max("hi").alias("max_date"),
        F.countDistinct("store_id").alias("n_stores"),
        F.countDistinct("stock_code").alias("n_products"),
        F.count("*").alias("n_pairs"),
        F.try_divide(F.sum("zero") * F.lit(100.0), F.sum("n")).alias("pct_zero"),
    )
