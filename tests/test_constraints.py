from datetime import date

import pytest
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators.constraints import quality_report, require_rows
from depotlens.plans import queries
from depotlens.plans.oracles import ORACLES
from depotlens.plans.queries import QUERIES
from depotlens.session import materialize

CFG = EngineConfig()


def test_empty_inputs_stop_a_job(spark):
    full, empty = spark.range(1), spark.range(0)
    require_rows(log=full)
    with pytest.raises(ValueError, match="no rows in items, daily"):
        require_rows(log=full, items=empty, daily=empty)


def report(spark, **mae):
    items = spark.createDataFrame([("1",), ("2",), ("2",)], "invoice_no string")
    orders = spark.createDataFrame([("1",)], "invoice_no string")
    daily = spark.createDataFrame([(1.0,), (-1.0,)], "revenue double")
    rows = [(name, value, value) for name, value in mae.items()]
    evaluation = spark.createDataFrame(rows, "model_name string, mae double, rmse double")
    found = quality_report(items, orders, daily, evaluation, CFG).collect()
    return {r["check_name"]: (r["failures"], r["status"]) for r in found}


def test_gates_and_the_comparison_of_models(spark):
    names = (CFG.model_name, CFG.baseline_name)
    both = report(spark, **dict(zip(names, (1.0, 2.0))))
    assert both["orphan_items"] == (2, "failed") and both["negative_revenue"] == (1, "failed")
    assert both["missing_models"] == (0, "passed")
    assert both["model_versus_baseline"] == (0, "model_beats_baseline")
    assert report(spark, **dict(zip(names, (2.0, 2.0))))["model_versus_baseline"] == (0, "baseline_not_beaten")
    alone = report(spark, **{CFG.baseline_name: 2.0})
    assert alone["missing_models"] == (1, "failed")
    assert alone["model_versus_baseline"] == (0, "not_compared")
    assert report(spark, **dict(zip(names, (-1.0, 2.0))))["invalid_metrics"] == (1, "failed")


def test_store_measures_do_not_compute_prices(spark, sf_dir):
    plan = QUERIES["inventory_measures_by_store"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" not in plan and "reference_unit_price" not in plan


def test_no_forced_broadcasts(spark, sf_dir):
    for name in ("training_frame", "policy_comparison", "top_products"):
        assert "strategy=broadcast" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().analyzed().toString()


def test_the_report_names_the_outcome_of_the_models(spark, sf_dir, monkeypatch):
    columns = "store_id string, stock_code string, snapshot_date date, units_demanded long, predicted_demand double, seasonal_naive_pred double"
    for model, baseline, outcome in ((4.0, 9.0, "model_beats_baseline"), (9.0, 4.0, "baseline_not_beaten")):
        scored = spark.createDataFrame([("LON", "A", date(2001, 6, 7), 5, model, baseline)], columns)
        monkeypatch.setattr(queries, "_scored", lambda *_, scored=scored: scored)
        found = {r["check_name"]: r["status"] for r in QUERIES["quality_report"](spark, sf_dir).collect()}
        assert found["model_versus_baseline"] == outcome
    assert "'model_beats_baseline'" in ORACLES["quality_report"]


def test_the_report_writes_log_and_items_once(spark, sf_dir, monkeypatch):
    written = []

    def noted(df, name):
        written.append(name)
        return materialize(df, name)

    monkeypatch.setattr(queries, "materialize", noted)
    monkeypatch.setattr(queries.forecast, "train_forecast", lambda *_: None)
    monkeypatch.setattr(queries.forecast, "predict", lambda _, rows: rows.withColumn("predicted_demand", F.lit(0.0)))
    assert QUERIES["quality_report"](spark, sf_dir).count() == 5
    assert written.count("lines") == 1 and written.count("order_items") == 1
