"""Marts kept up to date by the changes of a load instead of being computed from all items again.

A load replaces the items of some invoices. Their items before and after it give the change of every store and day they
touch; revenue and units are sums, and an invoice counts once a store and day, so changes of whole invoices are
changes of the counts, too. Profit follows from the days of the touched months. The correlation of two stores is
kept as sums over weeks (number, revenue, squares, products, in exact decimals), from which the touched weeks' old
products are taken and their new ones added. Nothing but the touched months is read.

All new rows of a batch are complete in its folder before the first table is changed. They are absolute values, so a
batch that was cut off, or that comes again, is finished from there and changes nothing twice.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.config import EngineConfig
from depotlens.operators import marts
from depotlens.schemas import TABLES, L, S, Table, struct
from depotlens.sources.upsert import TableStore

REVENUE, PRODUCT = T.DecimalType(19, 2), T.DecimalType(38, 4)
SUMS = {"sum_a": REVENUE, "sum_b": REVENUE, "sum_aa": PRODUCT, "sum_bb": PRODUCT, "sum_ab": PRODUCT}

#: Sums over the weeks in which both stores of a pair sold.
PAIR_SUMS = Table(
    "store_pair_sums",
    struct(store_id_a=S, store_id_b=S, weeks=L, **SUMS),
    keys=("store_id_a", "store_id_b"),
    not_null=("store_id_a", "store_id_b"),
)


def daily_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """What replacing the items ``before`` by ``after`` adds to each store and day; both hold whole invoices."""

    def signed(items: DataFrame, sign: int) -> DataFrame:
        daily = marts.store_daily_metrics(items)
        return daily.select("store_id", "metric_date", *((F.lit(sign) * F.col(c)).alias(c) for c in MEASURES))

    both = signed(before, -1).unionByName(signed(after, 1)).groupBy("store_id", "metric_date")
    kinds = {"revenue": "decimal(28,2)", "orders_count": "bigint", "units_sold": "bigint"}
    return both.agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in MEASURES))


MEASURES = ("revenue", "orders_count", "units_sold")


def changed_days(daily: DataFrame, change: DataFrame) -> DataFrame:
    """The new rows of the changed days; a day without orders any more stays, with zeros."""
    keys = ["store_id", "metric_date"]
    old = daily.select(*keys, *(F.col(c).alias(f"_{c}") for c in MEASURES))
    joined = change.join(old, keys, "left")
    zero = {c: F.lit(0).cast(change.schema[c].dataType) for c in MEASURES}
    return joined.select(*keys, *((F.coalesce(f"_{c}", zero[c]) + F.col(c)).cast(change.schema[c].dataType).alias(c) for c in MEASURES))


def with_changes(daily: DataFrame, changed: DataFrame) -> DataFrame:
    """The daily rows with the changed ones in their place, without days that have no orders."""
    kept = daily.join(changed, ["store_id", "metric_date"], "left_anti").unionByName(changed.select(*daily.columns))
    return kept.where("orders_count > 0")


def pair_sums(daily: DataFrame) -> DataFrame:
    """(pair, weeks, sums) over the weeks of the given days."""
    monday = F.date_sub("metric_date", F.weekday("metric_date"))
    weekly = daily.groupBy("store_id", monday.alias("week")).agg(F.sum("revenue").cast(REVENUE).alias("revenue"))
    a = weekly.select("week", F.col("store_id").alias("store_id_a"), F.col("revenue").alias("a"))
    b = weekly.select("week", F.col("store_id").alias("store_id_b"), F.col("revenue").alias("b"))
    both = a.join(b, "week").where("store_id_a < store_id_b")  # pairs of stores are the result itself
    terms = {"sum_a": F.col("a"), "sum_b": F.col("b"), "sum_aa": F.col("a") * F.col("a"), "sum_bb": F.col("b") * F.col("b"), "sum_ab": F.col("a") * F.col("b")}
    sums = [F.sum(term).cast(SUMS[name]).alias(name) for name, term in terms.items()]
    return both.groupBy("store_id_a", "store_id_b").agg(F.count("*").alias("weeks"), *sums)


def moved_sums(stored: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """The stored sums without the old weeks' part and with the new one."""
    names = ["weeks", *SUMS]
    signed = [df.select("store_id_a", "store_id_b", *((F.lit(sign) * F.col(n)).alias(n) for n in names)) for df, sign in ((stored, 1), (old, -1), (new, 1))]
    both = signed[0].unionByName(signed[1]).unionByName(signed[2]).groupBy("store_id_a", "store_id_b")
    return both.agg(F.sum("weeks").alias("weeks"), *(F.sum(n).cast(kind).alias(n) for n, kind in SUMS.items()))


def correlation_of(sums: DataFrame) -> DataFrame:
    """The correlation of every pair with a week in common; NULL where a store's revenue does not vary."""

    @F.pandas_udf("double")
    def pearson(n, a, b, aa, bb, ab):
        import pandas as pd

        def one(n: int, a: Decimal, b: Decimal, aa: Decimal, bb: Decimal, ab: Decimal) -> float | None:
            # Whole numbers of hundredths: differences of large sums stay exact.
            a, b, aa, bb, ab = (int(v * s) for v, s in ((a, 100), (b, 100), (aa, 10_000), (bb, 10_000), (ab, 10_000)))
            spread = (n * aa - a * a) * (n * bb - b * b)
            return (n * ab - a * b) / spread**0.5 if spread > 0 else None

        return pd.Series([one(int(row[0]), *row[1:]) for row in zip(n, a, b, aa, bb, ab)], dtype="float64")

    found = pearson("weeks", *SUMS)
    some = sums.where("weeks > 0").withColumn("r", found)
    value = F.when(~F.isnan("r"), F.col("r")).alias("weekly_revenue_correlation")
    return some.select("store_id_a", "store_id_b", value)


class IncrementalMarts:
    """The daily, profit and correlation marts of a table store, moved along by the changes of each load."""

    def __init__(self, store: TableStore, stores: DataFrame, cfg: EngineConfig):
        self.store, self.stores, self.cfg = store, stores, cfg

    def apply(self, batch_id: int, before: DataFrame, after: DataFrame, run_ts: datetime) -> list[date]:
        """Load the marts' new rows for invoices whose items were ``before`` and are ``after``; returns the months read."""
        place = f"{self.store.root}/marts/batch={batch_id}"
        names = ("store_daily_metrics", "store_profitability", PAIR_SUMS.name, "cross_store_correlation")
        fs, done = self.store._fs(f"{place}/{names[-1]}/_SUCCESS")
        months = [] if fs.exists(done) else self._stage(place, before, after)
        for name in names:
            rows = self.store.spark.read.parquet(f"{place}/{name}")
            table = TABLES.get(name, PAIR_SUMS)
            if "computed_at" in table.columns:
                rows = rows.withColumn("computed_at", F.lit(run_ts).cast("timestamp"))
            self.store.upsert(table, rows, on_duplicate="unique", written="computed_at" not in table.columns)
        return months

    def _stage(self, place: str, before: DataFrame, after: DataFrame) -> list[date]:
        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{place}/{name}")
            return self.store.spark.read.schema(df.schema).parquet(f"{place}/{name}")

        change = staged(daily_change(before, after), "change")
        days = [r[0] for r in change.select("metric_date").distinct().collect()]  # calendar days
        weeks = sorted({d - timedelta(days=d.weekday()) for d in days})
        near = {d.replace(day=1) for d in days} | {(w + timedelta(days=i)).replace(day=1) for w in weeks for i in (0, 6)}
        daily = self.store.read_months(TABLES["store_daily_metrics"], near)
        changed = staged(changed_days(daily, change), "store_daily_metrics")
        now = with_changes(daily, changed)
        months = F.trunc("metric_date", "month").isin([d.replace(day=1) for d in days])
        staged(marts.store_profitability(now.where(months), self.stores, self.cfg), "store_profitability")
        in_weeks = F.date_sub("metric_date", F.weekday("metric_date")).isin(weeks)
        old, new = (pair_sums(df.where(in_weeks)) for df in (daily.where("orders_count > 0"), now))
        sums = staged(moved_sums(self.store.read(PAIR_SUMS), old, new), PAIR_SUMS.name)
        staged(correlation_of(sums), "cross_store_correlation")  # the last one: its marker says that all are complete
        return sorted(near)
