from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from frames import day
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.schemas import TABLES, Table, struct
from depotlens.schemas import B, I, S
from depotlens.session import ensure_checkpoint_dir, materialize
from depotlens.sources.transactions import export_csv, export_json, land_raw, load_transactions, stores_table
from depotlens.sources.upsert import TableStore, keep_last, merge_rows

RUN = datetime(2011, 12, 10, tzinfo=timezone.utc)
PLAIN = Table("plain", struct(k=S, a=I, b=I), ("k",), defaults={"b": 9})
FLAGS = Table("flags", struct(k=S, on=B), ("k",), defaults={"on": True})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def test_csv_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(
        "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
        "536365,85123A,HOLDER,6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n"
        "C536379,22197,,-1,2010-12-01 09:41:00,27.5,,France\n"
    )
    got = load_transactions(spark, str(path), "csv").orderBy("line_no").collect()
    assert [r["stock_code"] for r in got] == ["85123A", "22197"]
    assert got[0]["customer_id"] == 17850 and got[1]["customer_id"] is None and got[1]["description"] is None
    assert got[0]["unit_price"] == Decimal("2.5500") and got[0]["invoice_date"] == datetime(2010, 12, 1, 8, 26)
    assert got[0]["line_no"] < got[1]["line_no"]


def test_parquet_and_orc_log_with_its_own_positions(spark, tmp_path):
    schema = (
        "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
        "Price decimal(18,4), `Customer ID` bigint, Country string, pos int"
    )
    df = spark.createDataFrame([("1", "A", "x", 1, datetime(2011, 1, 1), Decimal(1), 5, "EIRE", 42)], schema)
    for fmt in ("parquet", "orc"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert load_transactions(spark, str(tmp_path / fmt), fmt, line_column="pos").first()["line_no"] == 42


def test_stores_and_exports(spark, tmp_path):
    stores = stores_table(spark, EngineConfig())
    assert stores.columns == TABLES["stores"].columns and stores.count() == 6
    assert stores.where("is_synthetic").count() == 6
    export_csv(stores, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 6
    export_json(stores, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 6


def test_landing_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    path = land_raw(df, str(tmp_path), RUN)
    assert path.endswith("log/ingest_ts=20111210T000000Z")
    with pytest.raises(Exception, match="(?i)exists"):
        land_raw(df, str(tmp_path), RUN)


def test_materialized_frames_keep_their_pruning(spark):
    assert ensure_checkpoint_dir(spark)
    df = materialize(spark.range(10).select("id", (F.col("id") * 2).alias("double")), "t")
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and df.count() == 10


def test_merge_updates_inserts_and_never_deletes(spark):
    target = spark.createDataFrame([("x", 1, 1), ("y", 2, 2)], PLAIN.schema)
    full = spark.createDataFrame([("y", 5, 5), ("z", 6, 6)], PLAIN.schema)
    assert rows(merge_rows(target, full, ["k"])) == [("x", 1, 1), ("y", 5, 5), ("z", 6, 6)]
    partial = full.select("k", "a")
    assert rows(merge_rows(target, partial, ["k"], PLAIN.defaults)) == [("x", 1, 1), ("y", 5, 2), ("z", 6, 9)]
    keys_only = full.select("k")
    assert rows(merge_rows(target, keys_only, ["k"], {"a": 0, "b": 9})) == [("x", 1, 1), ("y", 2, 2), ("z", 0, 9)]
    nulls = spark.createDataFrame([("x", None, None)], PLAIN.schema)
    assert ("x", None, 1) in rows(merge_rows(target, nulls.select("k", "a"), ["k"]))


def test_upsert_is_idempotent(spark, store):
    batch = spark.createDataFrame([("x", 1, 1), ("y", 2, 2)], PLAIN.schema)
    assert rows(store.read(PLAIN)) == []
    assert store.upsert(PLAIN, batch) == 2
    once = rows(store.read(PLAIN))
    assert store.upsert(PLAIN, batch) == 2
    assert rows(store.read(PLAIN)) == once == [("x", 1, 1), ("y", 2, 2)]
    assert store.upsert(PLAIN, batch.limit(0)) == 0
    store.upsert(PLAIN, spark.createDataFrame([("x", 7)], "k string, a int"))
    assert rows(store.read(PLAIN)) == [("x", 7, 1), ("y", 2, 2)]
    assert store.drop_old_versions(PLAIN, keep=1) == 2
    assert len(rows(store.read(PLAIN))) == 2


def test_unfinished_versions_are_invisible(spark, store, tmp_path):
    store.upsert(PLAIN, spark.createDataFrame([("x", 1, 1)], PLAIN.schema))
    (tmp_path / "tables" / "plain" / "v2").mkdir()
    assert rows(store.read(PLAIN)) == [("x", 1, 1)]
    store.upsert(PLAIN, spark.createDataFrame([("y", 2, 2)], PLAIN.schema))
    assert len(rows(store.read(PLAIN))) == 2


def test_repeated_keys_raise_or_the_last_wins(spark, store):
    batch = spark.createDataFrame([("x", 1, 1), ("x", 2, 2), ("y", 3, 3)], PLAIN.schema)
    with pytest.raises(ValueError, match="repeats a key"):
        store.upsert(PLAIN, batch)
    assert not store.exists(PLAIN)
    assert store.upsert(PLAIN, batch, on_duplicate="last", order_by=F.col("b")) == 3
    assert rows(store.read(PLAIN)) == [("x", 2, 2), ("y", 3, 3)]
    with pytest.raises(ValueError):
        store.upsert(PLAIN, batch, on_duplicate="last")
    assert rows(keep_last(batch.select("k"), ["k"], F.col("k"))) == [("x",), ("y",)]


def test_defaults_and_run_time_are_applied(spark, store):
    store.upsert(FLAGS, spark.createDataFrame([("x",)], "k string"))
    assert rows(store.read(FLAGS)) == [("x", True)]
    table = TABLES["model_evaluation"]
    store.upsert(table, spark.createDataFrame([("m", 1.0, 2.0)], "model_name string, mae double, rmse double"), run_ts=RUN)
    assert store.read(table).where(F.col("computed_at") == F.lit(RUN)).count() == 1


def test_month_tables_rewrite_touched_months_only(spark, store, tmp_path):
    table = TABLES["inventory_snapshots"]

    def batch(*found):
        return spark.createDataFrame([("S", "A", d, u, 300 - u, False, True) for d, u in found], table.schema)

    store.upsert(table, batch((date(2011, 10, 30), 1), (date(2011, 11, 2), 2), (date(2011, 11, 3), 3)))
    october = sorted(p.name for p in (tmp_path / "tables/inventory_snapshots/key_month=2011-10-01").glob("*.parquet"))
    assert store.upsert(table, batch((date(2011, 11, 3), 30), (date(2011, 12, 1), 4))) == 2
    got = {r["snapshot_date"]: r["units_demanded"] for r in store.read(table).collect()}
    assert got == {date(2011, 10, 30): 1, date(2011, 11, 2): 2, date(2011, 11, 3): 30, date(2011, 12, 1): 4}
    assert october == sorted(p.name for p in (tmp_path / "tables/inventory_snapshots/key_month=2011-10-01").glob("*.parquet"))
    plan = store.read(table).where(F.col("snapshot_date") == F.lit(day(0)))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(snapshot_date" in plan


def test_a_date_range_prunes_months(spark, store):
    table = TABLES["inventory_snapshots"]
    dates = [date(2011, m, d) for m in (9, 10, 11) for d in (1, 15)]
    store.upsert(table, spark.createDataFrame([("S", "A", d, 1, 299, False, True) for d in dates], table.schema))
    part = store.read(table, date(2011, 9, 15), date(2011, 10, 14))
    assert sorted(r["snapshot_date"] for r in part.collect()) == [date(2011, 9, 15), date(2011, 10, 1)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "key_month" in filters[: filters.index("]")]
    assert store.read(table, last=date(2011, 8, 31)).count() == 0


def test_a_key_that_changes_month_leaves_no_old_row(spark, store):
    table = TABLES["orders"]

    def batch(*found):
        return spark.createDataFrame([(i, "LON", datetime(2011, m, 5, 9), None, None) for i, m in found], table.schema)

    store.upsert(table, batch(("1", 10), ("2", 10), ("3", 11)))
    store.upsert(table, batch(("1", 12), ("3", 12)))
    got = {r["invoice_no"]: r["order_date"].month for r in store.read(table).collect()}
    assert got == {"1": 12, "2": 10, "3": 12}
    assert store.read(table).count() == 3
    with pytest.raises(ValueError, match="is NULL"):
        store.upsert(table, spark.createDataFrame([("9", "LON", None, None, None)], table.schema))
    with pytest.raises(ValueError, match="places its rows"):
        store.upsert(table, spark.createDataFrame([("1", "MAN")], "invoice_no string, store_id string"))


def test_every_table_declares_its_key_columns():
    for table in TABLES.values():
        assert set(table.keys) <= set(table.columns) and set(table.not_null) <= set(table.columns)
        assert table.month_of is None or table.month_of in table.not_null
    assert len(TABLES) == 13


def test_a_load_cut_off_between_months_is_finished_later(spark, store, monkeypatch):
    table = TABLES["store_daily_metrics"]
    rows = [("LON", date(2011, m, d), Decimal(m * 100 + d), m, d) for m in range(1, 5) for d in (1, 2)]
    names = ["store_id", "metric_date", "revenue", "orders_count", "units_sold"]
    store.upsert(table, spark.createDataFrame(rows, names))
    change = spark.createDataFrame([("LON", date(2011, m, 2), Decimal(1), 0, 0) for m in (2, 3)], names)
    replace, calls = TableStore._replace_months, []

    def cut_off(self, table, place):
        """The first month is gone and nothing is written yet when the job dies."""
        calls.append(place)
        fs, month = self._fs(f"{self.root}/{table.name}/key_month=2011-02-01")
        fs.delete(month, True)
        raise RuntimeError("lost")

    monkeypatch.setattr(TableStore, "_replace_months", cut_off)
    with pytest.raises(RuntimeError):
        store.upsert(table, change)
    monkeypatch.setattr(TableStore, "_replace_months", replace)
    got = {(r["metric_date"].month, r["metric_date"].day): int(r["revenue"]) for r in store.read(table).collect()}
    want = {(m, d): m * 100 + d for m in range(1, 5) for d in (1, 2)} | {(2, 2): 1, (3, 2): 1}
    assert calls and got == want
    store.upsert(table, change)
    assert store.read(table).count() == 8


def test_half_of_a_first_load_is_not_a_table(spark, store, monkeypatch):
    table = TABLES["store_daily_metrics"]
    names = ["store_id", "metric_date", "revenue", "orders_count", "units_sold"]
    first = spark.createDataFrame([("LON", date(2011, 1, 1), Decimal(1), 1, 1)], names)
    monkeypatch.setattr(TableStore, "recover", lambda self, table: None)
    store.upsert(table, first)
    assert not store.exists(table)
    monkeypatch.undo()
    assert store.read(table).count() == 1
