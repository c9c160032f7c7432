import random
from datetime import datetime, timedelta

import pytest
from frames import START, line, panel, transactions
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators import marts
from depotlens.operators.conform import build_order_items
from depotlens.operators.panel import PAIR, replay_balance
from depotlens.schemas import TABLES
from depotlens.streaming.ingest import valid_lines
from depotlens.streaming.stateful import STATE_STORE, DailyMetricsStream, stock_stream

CFG = EngineConfig()


def rows(df):
    return sorted(map(repr, df.collect()))


def write(df, folder, n):
    """One file; the stream takes files by their time of change."""
    df.coalesce(1).write.mode("append").parquet(f"{folder}/arrived={n:03d}")


def test_daily_metrics_from_files_in_any_order_within_the_delay(spark, tmp_path):
    draw = random.Random(3)
    log = []
    for i in range(120):
        when = datetime(START.year, START.month, START.day, 9) + timedelta(days=i % 30)
        for p in draw.sample("ABC", 2):
            log.append(line(f"{i}", p, country=draw.choice(("EIRE", "France")), on=when, quantity=draw.randrange(1, 9), price="1.25", line_no=len(log)))
        if i % 4 == 0:
            log.append(line(f"{i}", p, country="EIRE", on=when, quantity=2, price="7", line_no=len(log)))
    # Arrival: by day, shifted at random by less than the delay.
    order = sorted(range(len(log)), key=lambda k: (log[k][4] + timedelta(days=draw.random() * 4)))
    folder, root = str(tmp_path / "lines"), str(tmp_path / "tables")
    chunks = [[log[k] for k in order[a : a + 90]] for a in range(0, len(order), 90)]
    late = [line("9999", "A", country="EIRE", on=datetime(2011, 10, 2), line_no=5000)]
    for n, chunk in enumerate([*chunks, late]):
        write(valid_lines(transactions(spark, *chunk), CFG), folder, n)
    lines = valid_lines(transactions(spark, *log), CFG)
    stream = DailyMetricsStream(spark, root, 5)
    source = spark.readStream.schema(spark.read.parquet(folder).drop("arrived").schema).option("maxFilesPerTrigger", 1)
    for query in stream.run_available(source.parquet(folder), str(tmp_path / "checkpoint")):
        assert query.awaitTermination(240) and query.exception() is None
    want = marts.store_daily_metrics(build_order_items(lines, CFG))
    newest = max(row[4] for row in log)
    final = want.where(F.col("metric_date") < F.lit((newest - timedelta(days=5)).date()))
    got = stream.store.read(TABLES["store_daily_metrics"])
    assert rows(got) == rows(final.select(*got.columns)) and got.count() > 20
    assert [r["invoice_no"] for r in spark.read.parquet(stream.late).collect()] == ["9999"]


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_stock_goes_on_after_a_restart(spark, tmp_path, rocks):
    draw = random.Random(4)
    series = {(s, p): [draw.randrange(0, 120) for _ in range(40)] for s in ("LON", "MAN") for p in "AB"}
    demand = panel(spark, series)
    folder, out, checkpoint = (str(tmp_path / n) for n in ("demand", "out", "checkpoint"))
    day = F.datediff("snapshot_date", F.lit(START))
    schema = demand.schema
    for n, (low, high) in enumerate(((0, 9), (9, 23), (23, 40))):
        write(demand.where((day >= low) & (day < high)), folder, n)
        if n == 2:  # a day that was replayed before
            write(demand.where(day == 4).limit(1), folder, 3)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        query = stock_stream(source, CFG).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
        query = query.trigger(availableNow=True).format("parquet").start(out)
        assert query.awaitTermination(240) and query.exception() is None
    got = spark.read.parquet(out)
    want = replay_balance(demand, PAIR, "snapshot_date", "units_demanded", F.lit(300), F.lit(300))
    names = ["store_id", "stock_code", "snapshot_date", "units_demanded", "stock_on_hand", "restocked"]
    assert rows(got.where("not late").select(*names)) == rows(want.select(*names))
    assert got.where("late").count() == 1
