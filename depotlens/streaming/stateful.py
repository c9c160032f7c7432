"""Daily metrics and stock balances as streams with state.

Daily metrics. Lines are summed to items, items to invoices and invoices to stores, per day of the event, behind one
watermark: a day is final once a line more than ``delay`` younger has been seen, and is then upserted. Lines of a day
that is final already are too late to count; they are kept aside with the batch they came in.

Stock. The balance of every store and product is the state of its key. A micro-batch brings further days, in any order
among themselves; days that are not behind the last one replayed are marked late and leave the balance alone. State
and output follow the checkpoint, so a stream that is stopped and started again goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from depotlens.config import EngineConfig
from depotlens.operators.conform import first_present
from depotlens.operators.panel import PAIR
from depotlens.schemas import TABLES
from depotlens.sources.upsert import TableStore

#: transformWithState keeps its state there.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def daily_metrics_stream(lines: DataFrame, delay: str) -> DataFrame:
    """(store_id, metric_date, revenue, orders_count, units_sold) of every day that is final, from a stream of lines."""
    timed = lines.withColumn("event", F.col("invoice_date").cast("timestamp")).withWatermark("event", delay)
    total = F.sum("quantity")
    items = timed.groupBy(F.window("event", "1 day").alias("day"), "store_id", "invoice_no", "stock_code").agg(
        total.alias("quantity"),
        F.bround(total * first_present("unit_price"), 2).cast("decimal(18,2)").alias("revenue"),
    )
    orders = items.groupBy("day", "store_id", "invoice_no").agg(F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"))
    daily = orders.groupBy("day", "store_id").agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        F.count("invoice_no").alias("orders_count"),
        F.sum("units").alias("units_sold"),
    )
    return daily.select("store_id", F.to_date("day.start").alias("metric_date"), "revenue", "orders_count", "units_sold")


class DailyMetricsStream:
    """The daily mart from a stream of valid lines; ``delay_days`` is how late a line may come."""

    def __init__(self, spark: SparkSession, root: str, delay_days: int = 7):
        self.spark, self.store, self.delay = spark, TableStore(spark, root), delay_days
        self.late = f"{self.store.root}/late_lines"
        self.seen = f"{self.store.root}/late_lines_seen"

    def load(self, daily: DataFrame, batch_id: int) -> None:
        table = TABLES["store_daily_metrics"]
        self.store.upsert(table, daily.select(*table.columns), on_duplicate="unique")

    def keep_late(self, lines: DataFrame, batch_id: int) -> None:
        """Lines whose day was final before their batch: the youngest event of earlier batches, less the delay, is behind it."""
        lines = lines.persist()
        try:
            newest = lines.agg(F.max("invoice_date").alias("newest"))
            newest.withColumn("batch", F.lit(batch_id)).coalesce(1).write.mode("overwrite").parquet(f"{self.seen}/part={batch_id}")
            seen = self.spark.read.parquet(self.seen).where(F.col("part") < batch_id).agg(F.max("newest")).first()[0]
            if seen is not None:
                ends = F.date_add(F.to_date("invoice_date"), 1).cast("timestamp_ntz")
                late = lines.where(ends <= F.lit(seen - timedelta(days=self.delay)))
                late.write.mode("overwrite").parquet(f"{self.late}/batch={batch_id}")
        finally:
            lines.unpersist()

    def run_available(self, lines: DataFrame, checkpoint: str) -> list[StreamingQuery]:
        """Process what there is and stop: one query for the metrics, one for the late lines."""
        daily = daily_metrics_stream(lines, f"{self.delay} days")
        queries = []
        for name, frame, work in (("metrics", daily, self.load), ("late", lines, self.keep_late)):
            writer = frame.writeStream.option("checkpointLocation", f"{checkpoint}/{name}")
            queries.append(writer.outputMode("append").trigger(availableNow=True).foreachBatch(work).start())
        return queries


class _Balance(StatefulProcessor):
    """One key's stock and the last day replayed."""

    def __init__(self, opening: int, refill: int):
        self.opening, self.refill = opening, refill

    def init(self, handle) -> None:
        self.state = handle.getValueState("balance", "stock long, day date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        batch = pd.concat(list(rows)).sort_values("snapshot_date", kind="stable").reset_index(drop=True)
        known = self.state.get() if self.state.exists() else None
        stock, last = (int(known[0]), known[1]) if known else (self.opening, None)
        levels, events, late = [], [], []
        for day, units in zip(batch["snapshot_date"], batch["units_demanded"]):
            if last is not None and day <= last:
                levels.append(None)
                events.append(False)
                late.append(True)
                continue
            stock -= int(units)
            event = stock <= 0
            stock = self.refill if event else stock
            last = day
            levels.append(stock)
            events.append(event)
            late.append(False)
        self.state.update((stock, last))
        batch["stock_on_hand"] = pd.array(levels, dtype="Int64")
        batch["restocked"], batch["late"] = events, late
        yield batch[[*PAIR, "snapshot_date", "units_demanded", "stock_on_hand", "restocked", "late"]]

    def close(self) -> None:
        pass


def stock_stream(demand: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Every row of a stream of daily demand (pair, day, units) with the stock behind it; needs ``STATE_STORE``."""
    given = demand.select(*PAIR, "snapshot_date", F.col("units_demanded").cast("bigint").alias("units_demanded"))
    return given.groupBy(*PAIR).transformWithStateInPandas(
        _Balance(cfg.starting_stock, cfg.par_level),
        "store_id string, stock_code string, snapshot_date date, units_demanded long, stock_on_hand long, restocked boolean, late boolean",
        "append",
        "none",
    )
