import random
from datetime import date, datetime, timedelta, timezone

import pytest
from frames import line, transactions
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators import increments, marts
from depotlens.schemas import TABLES
from depotlens.sources.transactions import stores_table
from depotlens.sources.upsert import TableStore
from depotlens.streaming.ingest import OrderIngest, valid_lines

CFG = EngineConfig()
RUN = datetime(2011, 12, 10, tzinfo=timezone.utc)
COUNTRIES = ("EIRE", "France", "Japan")


def batch(seed, first, days, invoices, known=()):
    """Lines of new invoices over some days, and more lines of known ones."""
    draw, rows = random.Random(seed), []
    for i in range(invoices):
        number, country = f"{seed}{i:03d}", draw.choice(COUNTRIES)
        when = first + timedelta(days=draw.randrange(days), hours=9)
        for p in draw.sample("ABCD", 2):
            rows.append((number, p, country, when, draw.randrange(1, 20), f"{draw.randrange(100, 900) / 100}"))
    for number, country, when in known:
        rows.append((number, draw.choice("ABCDE"), country, when, draw.randrange(1, 20), "3.5"))
    return [line(n, p, country=c, on=w, quantity=q, price=v, line_no=seed * 1000 + i) for i, (n, p, c, w, q, v) in enumerate(rows)]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    job = OrderIngest(spark, f"{root}/landing", root, CFG, with_marts=True)
    log, read = [], []
    seen = job.marts.store.read_months
    job.marts.store.read_months = lambda table, months: (read.append(set(months)), seen(table, months))[1]
    first = batch(1, datetime(2011, 9, 20), 60, 60)
    for number, lines in enumerate((first, batch(2, datetime(2011, 11, 19), 5, 12), None)):
        if lines is None:  # corrections of old invoices: other days and new prices of the first load
            old = [(r["invoice_no"], r["country"], r["invoice_date"]) for r in transactions(spark, *first[:6]).collect()]
            lines = batch(3, datetime(2011, 11, 24), 2, 2, old)
        log += lines
        job.load_batch(valid_lines(transactions(spark, *lines), CFG), number, RUN)
    return job, log, read


def rows(df):
    return sorted(map(repr, df.collect()))


def same(store, spark):
    """The marts equal those computed from all items."""
    items = store.read(TABLES["order_items"])
    daily = marts.store_daily_metrics(items)
    stored = store.read(TABLES["store_daily_metrics"]).where("orders_count > 0")
    assert rows(stored) == rows(daily.select(*stored.columns))
    profit = marts.store_profitability(daily, stores_table(spark, CFG), CFG)
    got = store.read(TABLES["store_profitability"]).drop("computed_at")
    assert rows(got) == rows(profit.select(*got.columns))
    want = {r[:2]: r[2] for r in marts.cross_store_correlation(daily).collect()}
    found = {(r[0], r[1]): r[2] for r in store.read(TABLES["cross_store_correlation"]).collect()}
    assert set(found) == set(want) and len(want) == 3
    for pair, value in want.items():
        assert found[pair] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_three_loads_with_corrections_equal_a_full_computation(spark, loaded):
    job, log, _ = loaded
    assert job.store.read(TABLES["order_items"]).count() == valid_lines(transactions(spark, *log), CFG).select("invoice_no", "stock_code").distinct().count()
    same(job.store, spark)


def test_only_touched_months_are_read(spark, loaded):
    job, _, read = loaded
    assert read[1] == {date(2011, 11, 1)}
    assert date(2011, 10, 1) not in read[1] and len(read) == 3
    plan = job.store.read_months(TABLES["store_daily_metrics"], [date(2011, 11, 1)])._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "key_month" in filters[: filters.index("]")]


def test_a_repeated_or_interrupted_batch_changes_nothing_twice(spark, loaded, monkeypatch):
    job, log, _ = loaded
    before = rows(job.store.read(TABLES["store_daily_metrics"]))
    again = [row for row in log if row[-1] // 1000 == 3] if isinstance(log[0], tuple) else [r for r in log if r["line_no"] // 1000 == 3]
    job.load_batch(valid_lines(transactions(spark, *again), CFG), 2, RUN)
    assert rows(job.store.read(TABLES["store_daily_metrics"])) == before
    # Cut off after the first table.
    more = batch(4, datetime(2011, 11, 26), 2, 4)
    upsert, calls = TableStore.upsert, []

    def fails(self, table, *args, **kwargs):
        calls.append(table.name)
        if table.name == "store_profitability":
            raise RuntimeError("lost")
        return upsert(self, table, *args, **kwargs)

    monkeypatch.setattr(TableStore, "upsert", fails)
    lines = valid_lines(transactions(spark, *more), CFG)
    with pytest.raises(RuntimeError):
        job.load_batch(lines, 3, RUN)
    monkeypatch.undo()
    assert "store_daily_metrics" in calls
    job.load_batch(lines, 3, RUN)
    same(job.store, spark)


def test_a_store_that_does_not_vary_has_no_correlation(spark):
    daily = spark.createDataFrame(
        [(s, date(2011, 10, 3) + timedelta(days=7 * k), v, 1, 1) for s, series in {"A": (1, 2, 4), "B": (5, 5, 5), "C": (2, 4, 9)}.items() for k, v in enumerate(series)],
        "store_id string, metric_date date, revenue int, orders_count int, units_sold int",
    ).withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))
    found = {tuple(r[:2]): r[2] for r in increments.correlation_of(increments.pair_sums(daily)).collect()}
    want = {tuple(r[:2]): r[2] for r in marts.cross_store_correlation(daily).collect()}
    assert found[("A", "B")] is None and want[("A", "B")] is None
    assert found[("A", "C")] == pytest.approx(want[("A", "C")], abs=1e-12)
