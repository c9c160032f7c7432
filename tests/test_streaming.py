from datetime import datetime, timezone

from frames import day, line, transactions

from depotlens.config import EngineConfig
from depotlens.operators.conform import build_order_items, build_orders
from depotlens.schemas import TABLES
from depotlens.sources.transactions import land_raw
from depotlens.streaming.ingest import OrderIngest, valid_lines

CFG = EngineConfig()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_files_that_arrive_later_give_the_same_tables_as_one_batch(spark, tmp_path):
    first = [line("1", "A", quantity=2, price="3", line_no=1), line("1", "B", line_no=2)]
    first += [line("2", "A", line_no=3), line("C9", line_no=4)]
    later = [line("1", "A", quantity=5, price="9", line_no=5, on=day(-1))]
    later += [line("3", "A", line_no=6, on=day(40)), line("4", price="0.0001", line_no=7)]
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    job = OrderIngest(spark, f"{landing}/log", root, CFG)
    for hour, batch in enumerate((first, later)):
        land_raw(transactions(spark, *batch), landing, datetime(2011, 12, 9, hour, tzinfo=timezone.utc))
        query = job.run_available(str(tmp_path / "checkpoint"))
        assert query.awaitTermination(120) and query.exception() is None
    everything = valid_lines(transactions(spark, *first, *later), CFG)
    orders, items = TABLES["orders"], TABLES["order_items"]
    assert rows(job.store.read(orders)) == rows(build_orders(everything).select(*orders.columns))
    assert rows(job.store.read(items)) == rows(build_order_items(everything, CFG).select(*items.columns))
    job.load_batch(valid_lines(transactions(spark, *later), CFG), 1)
    assert rows(job.store.read(items)) == rows(build_order_items(everything, CFG).select(*items.columns))
