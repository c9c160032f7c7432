"""The order load as an incremental job: landed log files in, upserted orders and items out.

The batch job reloads the whole log; this one takes the files that arrived since its last run and
writes the same rows. An invoice may be spread over several files, so its header and items are
rebuilt from all of its lines and not from the new ones alone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from depotlens.config import EngineConfig
from depotlens.operators import conform
from depotlens.operators.cleaning import clean_transactions, route_orders
from depotlens.operators.increments import IncrementalMarts
from depotlens.operators.validation import validate_transactions
from depotlens.schemas import TABLES, TRANSACTIONS
from depotlens.session import materialize
from depotlens.sources.transactions import stores_table
from depotlens.sources.upsert import TableStore


def valid_lines(log: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The row-wise steps; the same expressions serve a batch and a stream."""
    return validate_transactions(route_orders(clean_transactions(log), cfg), cfg).valid


class OrderIngest:
    def __init__(self, spark: SparkSession, landing: str, root: str, cfg: EngineConfig, with_marts: bool = False):
        self.spark, self.landing, self.cfg = spark, landing.rstrip("/"), cfg
        self.store = TableStore(spark, root)
        self.lines = f"{self.store.root}/lines"
        self.marts = IncrementalMarts(self.store, stores_table(spark, cfg), cfg) if with_marts else None

    def load_batch(self, lines: DataFrame, batch_id: int, run_ts: datetime | None = None) -> None:
        """Keep the new lines, then upsert the orders they touch. Repeating a batch writes the same rows again."""
        place = f"{self.lines}/batch={batch_id}"
        lines.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(place)
        fresh = self.spark.read.schema(lines.schema).parquet(place)
        earlier = self._earlier_lines(fresh, batch_id)
        touched = fresh.unionByName(earlier)
        after = conform.build_order_items(touched, self.cfg)
        for name, frame in (("orders", conform.build_orders(touched)), ("order_items", after)):
            self.store.upsert(TABLES[name], frame.select(*TABLES[name].columns))
        if self.marts:
            before = conform.build_order_items(earlier, self.cfg)
            self.marts.apply(batch_id, before, after, run_ts or datetime.now(timezone.utc))

    def _earlier_lines(self, fresh: DataFrame, batch_id: int) -> DataFrame:
        """Lines of other batches on the same invoices; none, and no scan, if no invoice is known yet."""
        invoices = fresh.select("invoice_no").distinct()
        # Written, because the orders it reads are replaced before the items are built from it.
        known = materialize(invoices.join(self.store.read(TABLES["orders"]), "invoice_no", "left_semi"), "known_invoices")
        if known.isEmpty():
            return fresh.limit(0)
        schema = T.StructType([*fresh.schema.fields, T.StructField("batch", T.LongType())])
        kept = self.spark.read.schema(schema).parquet(self.lines).where(F.col("batch") != batch_id)
        return kept.join(known, "invoice_no", "left_semi").select(*fresh.columns)

    def run_available(self, checkpoint: str, max_files: int = 1000) -> StreamingQuery:
        """Process what has landed and stop; ``checkpoint`` remembers the files that are done."""
        log = (
            self.spark.readStream.schema(TRANSACTIONS)
            .option("maxFilesPerTrigger", max_files)
            .json(f"{self.landing}/ingest_ts=*")
        )
        return (
            valid_lines(log, self.cfg)
            .writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(self.load_batch)
            .start()
        )
