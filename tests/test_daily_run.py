from dataclasses import replace

import pytest
from frames import line, transactions

from depotlens.operators.constraints import constraint_report
from depotlens.operators.panel import panel_overview
from depotlens.plans.daily_run import DailyRun, run_pipeline
from depotlens.plans.queries import CFG, RUN_TS
from depotlens.schemas import TABLES
from depotlens.sources.sales_log import sales_log
from depotlens.sources.upsert import TableStore

SMALL = replace(CFG, trees=2, min_density=0.02, max_invalid_ratio=0.1, search_folds=1)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("tables"))


@pytest.fixture(scope="module")
def result(spark, root):
    return run_pipeline(spark, sales_log(spark, "/root/testdata/sf0.001", "type"), root, SMALL, RUN_TS, with_search=True)


def content(spark, root):
    store = TableStore(spark, root)
    return {
        n: sorted(map(repr, store.read(t).collect())) for n, t in TABLES.items() if n not in ("automl_leaderboard",)
    }


def test_all_tables_are_loaded_and_consistent(spark, root, result):
    store = TableStore(spark, root)
    assert set(result.loaded) == set(TABLES)
    assert result.mart_rows["store_daily_metrics"] == store.read(TABLES["store_daily_metrics"]).count()
    frames = {n: store.read(t) for n, t in TABLES.items()}
    for name, table in TABLES.items():
        broken = constraint_report(table, frames[name], frames).where("violations > 0").collect()
        assert not broken, (name, broken)
    overview = panel_overview(frames["inventory_snapshots"]).first()
    days = (overview["max_date"] - overview["min_date"]).days + 1
    assert overview["total_rows"] == overview["n_pairs"] * days
    assert set(result.metrics) == {CFG.model_name, CFG.baseline_name}
    assert set(result.policies) == {CFG.fixed_policy, CFG.forecast_policy}
    assert result.split["test_rows"] % result.split["dense_pairs"] == 0
    assert result.validation.rule_counts == {"unit_price_in_range": result.validation.invalid_rows}
    assert frames["demand_forecast_predictions"].count() == 2 * result.split["test_rows"]
    assert spark.table("sales_summary").count() == frames["store_daily_metrics"].count()
    assert frames["automl_leaderboard"].where("is_leader").count() == 1


def test_a_second_run_changes_nothing(spark, root, result):
    before = content(spark, root)
    run_pipeline(spark, sales_log(spark, "/root/testdata/sf0.001", "type"), root, SMALL, RUN_TS)
    assert content(spark, root) == before


def test_one_product_of_one_invoice_at_two_stores_stops_the_run(spark, tmp_path):
    rows = [line("1", "A", country="EIRE", line_no=1), line("1", "A", country="France", line_no=2)]
    with pytest.raises(ValueError, match="at two stores"):
        run_pipeline(spark, transactions(spark, *rows), str(tmp_path), SMALL, RUN_TS)


def test_a_split_invoice_of_different_products_is_loaded(spark, tmp_path):
    rows = [line("1", "A", country="EIRE", line_no=1), line("1", "B", country="France", line_no=2)]
    run = DailyRun(spark, str(tmp_path), SMALL, RUN_TS)
    lines, report = run.validate(transactions(spark, *rows))
    assert report.is_valid and run.conform(lines).count() == 2
    assert run.store.read(TABLES["orders"]).first()["store_id"] == "DUB"


def test_too_many_invalid_rows_stop_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="validation failed"):
        run_pipeline(spark, sales_log(spark, "/root/testdata/sf0.001"), str(tmp_path), replace(SMALL, max_invalid_ratio=0.001), RUN_TS)
    assert not (tmp_path / "orders").exists()


def test_the_report_is_counted_while_the_rows_are_written(spark, tmp_path):
    rows = [line("1", "A", line_no=1), line("2", "B", price="0.0001", line_no=2), line("3", quantity=200_000, price="0.0001", line_no=3)]
    run = DailyRun(spark, str(tmp_path), SMALL, RUN_TS)
    lines, report = run.validate(transactions(spark, *rows))
    assert (report.total_rows, report.valid_rows) == (3, 1)
    assert report.rule_counts == {"unit_price_in_range": 2, "quantity_in_range": 1}
    assert lines.count() == 1
    empty, none = run.validate(transactions(spark, *rows).limit(0))
    assert (none.total_rows, none.valid_rows, dict(none.rule_counts)) == (0, 0, {}) and empty.isEmpty()
