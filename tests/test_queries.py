"""Every registered query against its SQL counterpart.

TEST_SF_DIR picks the scale; queries over the dense pairs need one where such pairs exist.
"""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_module
from depotlens.plans.oracles import ORACLES
from depotlens.plans.queries import QUERIES

DENSE = {
    "busiest_pair",
    "demand_features",
    "dense_pairs",
    "dense_pairs_by_store",
    "forecast_evaluation",
    "forecast_predictions",
    "forecast_split",
    "leaderboard",
    "out_of_fold",
    "stacked_baselines",
    "one_hot_positions",
    "policy_change",
    "policy_comparison",
    "policy_largest_increases",
    "policy_pivot",
    "policy_totals",
    "policy_with_model",
    "restock_with_model",
    "quality_report",
    "ranked_models",
    "restock_from_predictions",
    "restock_distribution",
    "seasonal_naive_eval",
    "stacked_predictions",
    "training_frame",
}
ORDERED = {"policy_totals", "profit_months", "profit_ranking", "policy_largest_increases", "worst_stockouts"}
DENSE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck(sf_dir):
    return {folder: connect(folder) for folder in {sf_dir, DENSE_DIR}}


def test_registry():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    folder = DENSE_DIR if name in DENSE else sf_dir
    df = entry_module.queries()[name](spark, folder)
    if name in DENSE:
        assert not df.isEmpty()
    assert difference(df, duck[folder], entry_module.oracle_sql()[name], name in ORDERED) is None
