"""Idempotent loads: insert new keys, update existing ones, never delete.

Spark cannot overwrite files it is reading, so a load stages its batch, writes the merged rows to a
new place and only then makes them current:

* tables partitioned by month rewrite the touched months only (dynamic partition overwrite from a
  complete copy under ``pending``). Months are replaced one by one; the copy is deleted after the last, so a
  load that was cut off in between is finished by the next read or load, and no row of it or of an earlier
  load is lost. A marker is set after the first load, so half of it is never read as the table;
* other tables get a new version directory. The current version is the highest one that carries
  the committer's ``_SUCCESS`` marker, so a failed or half-written load is never visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.schemas import TABLES, Table

MONTH, LOADED = "key_month", "_LOADED"


def keep_last(batch: DataFrame, keys: Sequence[str], order_by: Column) -> DataFrame:
    """One row per key, the last by ``order_by``; a max per key, so a hot key stays one buffer."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.dropDuplicates(list(keys))
    return batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_by).alias("_row")).select(*keys, "_row.*")


def merge_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], defaults: dict[str, Any] | None = None
) -> DataFrame:
    """Target rows after the upsert. Columns the batch lacks keep their old value, or get the default on insert."""
    keys = list(keys)
    given = [c for c in target.columns if c in batch.columns]
    updates = [c for c in given if c not in keys]
    if not updates:
        fresh = batch.join(target, keys, "left_anti")
        return target.unionByName(_complete(fresh, target, defaults))
    if set(given) == set(target.columns):
        return target.join(batch, keys, "left_anti").unionByName(_complete(batch, target, defaults))
    old = target.withColumn("_old", F.lit(True)).alias("o")
    new = batch.withColumn("_new", F.lit(True)).alias("n")
    merged = old.join(new, keys, "full_outer")
    picked = []
    for name in target.columns:
        kind = target.schema[name].dataType
        if name in keys:
            picked.append(F.col(name))
        elif name in updates:
            picked.append(F.when(F.col("_new"), F.col(f"n.{name}").cast(kind)).otherwise(F.col(f"o.{name}")).alias(name))
        else:
            default = F.lit((defaults or {}).get(name)).cast(kind)
            picked.append(F.when(F.col("_old"), F.col(f"o.{name}")).otherwise(default).alias(name))
    return merged.select(*picked)


def _complete(batch: DataFrame, target: DataFrame, defaults: dict[str, Any] | None) -> DataFrame:
    return batch.select(
        *(
            (F.col(f.name) if f.name in batch.columns else F.lit((defaults or {}).get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema
        )
    )


class TableStore:
    """The engine's tables under one root folder, any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _versions(self, table: Table) -> list[int]:
        fs, path = self._fs(f"{self.root}/{table.name}")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        found = sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())
        return [v for v in found if fs.exists(self._fs(f"{self.root}/{table.name}/v{v}/_SUCCESS")[1])]

    def exists(self, table: Table) -> bool:
        if table.month_of:
            fs, path = self._fs(f"{self.root}/{table.name}/{LOADED}")
            return fs.exists(path)
        return bool(self._versions(table))

    def recover(self, table: Table) -> None:
        """Finish a load that was interrupted while it replaced months; before that point nothing was touched."""
        place = f"{self.root}/pending/{table.name}"
        fs, path = self._fs(place)
        if not fs.exists(path):
            return
        if fs.exists(self._fs(f"{place}/months/_SUCCESS")[1]):  # written last, so the rows are complete
            self._replace_months(table, place)
        fs.delete(path, True)

    def _replace_months(self, table: Table, place: str) -> None:
        """Put the staged rows in the place of the months they stand for; doing it again does no harm."""
        path = f"{self.root}/{table.name}"
        schema = T.StructType([*table.schema.fields, T.StructField(MONTH, T.DateType())])
        rows = self.spark.read.schema(schema).parquet(f"{place}/rows")
        # Clustered by month: few files per month, and a hot month is still split over several tasks.
        (
            rows.hint("rebalance", MONTH)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH)
            .parquet(path)
        )
        # A month whose last rows moved away gets no new files, so its old ones are removed here.
        emptied = self.spark.read.parquet(f"{place}/months").where("emptied").select(MONTH).collect()
        for row in emptied:
            fs, old = self._fs(f"{path}/{MONTH}={row[0]}")
            fs.delete(old, True)
        fs, marker = self._fs(f"{path}/{LOADED}")
        fs.create(marker, True).close()

    def read(self, table: Table, first: date | None = None, last: date | None = None) -> DataFrame:
        """The current rows; an empty frame with the declared schema before the first load.

        A date range on a month table prunes its partitions, and its rows in the files that remain.
        """
        if table.month_of:
            self.recover(table)
        if not self.exists(table):
            return self.spark.createDataFrame([], table.schema)
        if table.month_of:
            rows = self._read_months(table)
            for bound, holds in ((first, Column.__ge__), (last, Column.__le__)):
                if bound:
                    month = holds(F.col(MONTH), F.lit(bound.replace(day=1)))
                    rows = rows.where(month & holds(F.col(table.month_of).cast("date"), F.lit(bound)))
            return rows.select(*table.columns)
        return self.spark.read.schema(table.schema).parquet(f"{self.root}/{table.name}/v{self._versions(table)[-1]}")

    def read_months(self, table: Table, months: Iterable[date]) -> DataFrame:
        """The current rows of the given months (their first days); no other month's files are listed or read."""
        self.recover(table)
        if not self.exists(table):
            return self.spark.createDataFrame([], table.schema)
        return self._read_months(table).where(F.col(MONTH).isin(list(months))).select(*table.columns)

    def _read_months(self, table: Table) -> DataFrame:
        schema = T.StructType([*table.schema.fields, T.StructField(MONTH, T.DateType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table.name}")

    def upsert(
        self,
        table: Table,
        batch: DataFrame,
        *,
        on_duplicate: str = "error",
        order_by: Column | None = None,
        run_ts: datetime | None = None,
        written: bool = False,
    ) -> int:
        """Merge ``batch`` into the stored table and return the number of rows submitted.

        ``on_duplicate`` is ``error`` or ``last`` (by ``order_by``) for keys repeated in the batch, or
        ``unique`` for a batch that was grouped by the key, which saves the shuffle that would check it.
        ``written`` says that the batch is read from files already, so it is not staged again.
        """
        if on_duplicate not in ("error", "last", "unique"):
            raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
        if on_duplicate == "last" and order_by is None:
            raise ValueError("on_duplicate='last' needs order_by")
        staging = f"{self.root}/staging/{table.name}-{uuid.uuid4().hex}"
        try:
            # The staged copy cuts the lineage: the checks and the merge read files, not the job that made them.
            staged = batch if written else self._staged(batch, f"{staging}/batch")
            submitted = staged.count()
            if submitted == 0:
                return 0
            if on_duplicate == "last":
                staged = keep_last(staged, table.keys, order_by)
            elif on_duplicate == "error" and not staged.groupBy(*table.keys).count().where("count > 1").isEmpty():
                raise ValueError(f"{table.name}: the batch repeats a key of {table.keys}")
            defaults = dict(table.defaults)
            for stamp in ("computed_at", "trained_at"):
                if run_ts is not None and stamp in table.columns:
                    defaults[stamp] = run_ts
            if table.month_of:
                self._merge_months(table, staged, defaults)
            else:
                self._merge_version(table, staged, defaults)
            return submitted
        finally:
            fs, path = self._fs(staging)
            fs.delete(path, True)

    def _staged(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _merge_version(self, table: Table, staged: DataFrame, defaults: dict[str, Any]) -> None:
        versions = self._versions(table)
        merged = merge_rows(self.read(table), staged, table.keys, defaults)
        number = versions[-1] + 1 if versions else 1
        merged.write.mode("overwrite").parquet(f"{self.root}/{table.name}/v{number}")

    def _merge_months(self, table: Table, staged: DataFrame, defaults: dict[str, Any]) -> None:
        """Rewrite the months the batch falls in, and those that hold its keys now if a key can change month."""
        if table.month_of not in staged.columns:
            raise ValueError(f"{table.name}: a batch needs {table.month_of}, which places its rows")
        month = F.trunc(F.col(table.month_of).cast("date"), "month").alias(MONTH)
        self.recover(table)
        # One row per calendar month, so these lists are bounded by the calendar.
        touched = {r[0] for r in staged.select(month).distinct().collect()}
        if None in touched:
            raise ValueError(f"{table.name}: {table.month_of} is NULL in some rows")
        current = self.spark.createDataFrame([], table.schema)
        if self.exists(table):
            stored = self._read_months(table)
            if table.month_of not in table.keys:
                keys = list(table.keys)
                inside = stored.where(F.col(MONTH).isin(list(touched))).select(*keys)
                moved = staged.select(*keys).join(inside, keys, "left_anti")
                held = stored.where(~F.col(MONTH).isin(list(touched))).join(moved, keys, "left_semi")
                touched |= {r[0] for r in held.select(MONTH).distinct().collect()}
            current = stored.where(F.col(MONTH).isin(list(touched))).select(*table.columns)
        else:
            fs, path = self._fs(f"{self.root}/{table.name}")
            fs.delete(path, True)  # what a first load that did not finish has left
        merged = merge_rows(current, staged, table.keys, defaults).withColumn(MONTH, month)
        # The rows that replace the months are complete in `pending` before a month is touched, and stay there
        # until all are replaced: an interrupted load is finished by the next read or load of the table.
        place = f"{self.root}/pending/{table.name}"
        merged.write.mode("overwrite").parquet(f"{place}/rows")
        left = {r[0] for r in self.spark.read.parquet(f"{place}/rows").select(MONTH).distinct().collect()}
        months = [(m, m not in left) for m in sorted(touched)]
        self.spark.createDataFrame(months, f"{MONTH} date, emptied boolean").coalesce(1).write.mode("overwrite").parquet(f"{place}/months")
        self.recover(table)

    def drop_old_versions(self, table: Table, keep: int = 2) -> int:
        """Remove superseded versions, leaving the newest ``keep`` for readers that are still open."""
        stale = self._versions(table)[:-keep]
        for version in stale:
            fs, path = self._fs(f"{self.root}/{table.name}/v{version}")
            fs.delete(path, True)
        return len(stale)


def merge_upsert(spark: SparkSession, root: str, table: str, batch: DataFrame, **options: Any) -> int:
    """Upsert a batch into one of the engine's tables by name; see ``TableStore.upsert``."""
    return TableStore(spark, root).upsert(TABLES[table], batch, **options)
