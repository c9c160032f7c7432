from decimal import Decimal

import pytest
from frames import line, transactions
from pyspark.sql import functions as F

from depotlens.config import EngineConfig
from depotlens.operators.cleaning import clean_transactions, route_orders
from depotlens.operators.validation import Rules, validate, validate_transactions


def marked_rows(validation):
    return [i for i, r in enumerate(validation.marked.collect()) if r["violations"]]


def test_missing_columns_are_one_error_and_nothing_is_valid(spark):
    checked = validate(spark.createDataFrame([(1,), (2,)], "a int"), Rules(required_columns=("a", "b")))
    report = checked.report()
    assert not report.is_valid
    assert "missing required columns" in report.errors[0]
    assert (report.total_rows, report.valid_rows) == (2, 0)
    with pytest.raises(ValueError):
        report.raise_if_invalid(1.0)


def test_nulls_break_the_not_null_rule(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "a double").coalesce(1)
    checked = validate(df, Rules(required_columns=("a",), not_null_columns=("a",)))
    assert checked.report().valid_rows == 2
    assert marked_rows(checked) == [1]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "a double")
    assert validate(df, Rules(not_null_columns=("a",))).report().valid_rows == 1
    assert validate(df, Rules(numeric_ranges={"a": (0, 5)})).report().valid_rows == 1


def test_ranges_are_inclusive_and_null_is_outside(spark):
    df = spark.createDataFrame([(-100,), (20,), (150,)], "temp int").coalesce(1)
    checked = validate(df, Rules(required_columns=("temp",), numeric_ranges={"temp": (-60, 60)}))
    assert checked.report().valid_rows == 1
    assert marked_rows(checked) == [0, 2]
    edges = spark.createDataFrame([(-60,), (60,), (None,)], "temp int")
    assert validate(edges, Rules(numeric_ranges={"temp": (-60, 60)})).report().valid_rows == 2


def test_allowed_values(spark):
    df = spark.createDataFrame([("ok",), ("bad",), ("ok",), (None,)], "status string").coalesce(1)
    checked = validate(df, Rules(required_columns=("status",), allowed_values={"status": {"ok"}}))
    assert marked_rows(checked) == [1, 3]


def test_ratio_at_the_threshold_passes(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    report = validate(df, Rules(required_columns=("a",), not_null_columns=("a",))).report()
    report.raise_if_invalid(max_invalid_ratio=0.5)
    with pytest.raises(ValueError):
        report.raise_if_invalid(max_invalid_ratio=0.1)


def test_no_rows_is_ratio_zero(spark):
    report = validate(spark.createDataFrame([], "a int"), Rules(not_null_columns=("a",))).report()
    report.raise_if_invalid()
    assert report.is_valid


def test_a_missing_invoice_is_quarantined_not_lost(spark):
    rows = transactions(spark, line(None), line("1"))
    checked = validate_transactions(route_orders(clean_transactions(rows), EngineConfig()), EngineConfig())
    assert [r["violations"] for r in checked.quarantined.collect()] == [["invoice_no_not_null"]]
    assert checked.valid.count() == 1


def test_rules_union_per_row_and_split_is_complete(spark):
    rows = transactions(
        spark,
        line(quantity=1, price="0.001"),
        line(quantity=100_000, price="100000"),
        line(quantity=100_001, price="100000.0001"),
        line(stock=None),
    )
    checked = validate_transactions(route_orders(rows, EngineConfig()), EngineConfig())
    assert checked.valid.count() == 2
    found = {tuple(r["violations"]) for r in checked.quarantined.collect()}
    assert found == {("quantity_in_range", "unit_price_in_range"), ("stock_code_not_null",)}
    report = checked.report()
    assert report.rule_counts["unit_price_in_range"] == 1 and report.invalid_rows == 2
    assert checked.valid.agg(F.max("unit_price")).first()[0] == Decimal("100000")
