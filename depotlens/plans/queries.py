"""The registered queries: each takes (spark, sf_dir) and runs over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from functools import cached_property

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from depotlens.config import EngineConfig
from depotlens.operators import conform, constraints, features, forecast, marts, panel, policy, reporting, stacking
from depotlens.operators.cleaning import clean_transactions, route_orders
from depotlens.operators.validation import Rules, validate, validate_transactions
from depotlens.schemas import TABLES
from depotlens.session import materialize, scratch_path
from depotlens.sources.sales_log import sales_log
from depotlens.sources.transactions import LOG_HEADERS, load_transactions, stores_table
from depotlens.sources.upsert import keep_last, merge_rows
from depotlens.sources.workbook import register

# The given tables end on 2001-08-01; this date leaves 56 test days.
CFG = EngineConfig(test_start=date(2001, 6, 7))
RUN_TS = datetime(2001, 8, 2, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]
_MODELS = {CFG.model_name: forecast.PREDICTION, CFG.baseline_name: "seasonal_naive_pred"}


#: The columns of a line that items, orders and products are made of.
LINE_COLUMNS = (
    "invoice_no", "stock_code", "store_id", "quantity", "unit_price", "invoice_date", "customer_id", "country", "line_no",
)


class Workspace:
    """The composed frames of one data folder.

    Lazy, unless ``shared`` says that several results are built from the lines: then the log is joined,
    cleaned and validated once and its columns that are used are written, instead of once per result.
    ``described`` asks for product descriptions, ``stored_items`` has the items written, for several results
    from them.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        grain: str = "part",
        shared: bool = False,
        described: bool = False,
        stored_items: bool = False,
    ):
        self.cfg = CFG
        self.log = sales_log(spark, sf_dir, grain, described)
        self.routed = route_orders(clean_transactions(self.log), CFG)
        self.validation = validate_transactions(self.routed, CFG)
        self.lines = self.validation.valid
        if shared:
            names = [*LINE_COLUMNS, "description"] if described else LINE_COLUMNS
            self.lines = materialize(self.lines.select(*names), "lines")
        self.stores = stores_table(spark, CFG)
        self.stored_items = stored_items

    @property
    def products(self) -> DataFrame:
        return conform.build_products(self.lines)

    @property
    def orders(self) -> DataFrame:
        return conform.build_orders(self.lines)

    @property
    def items(self) -> DataFrame:
        return self._written_items if self.stored_items else conform.build_order_items(self.lines, self.cfg)

    @cached_property
    def _written_items(self) -> DataFrame:
        return materialize(conform.build_order_items(self.lines, self.cfg), "order_items")

    @property
    def daily(self) -> DataFrame:
        return marts.store_daily_metrics(self.items)

    @cached_property
    def stored_daily(self) -> DataFrame:
        return materialize(self.daily, "store_daily_metrics")

    @cached_property
    def stored_demand(self) -> DataFrame:
        """Daily demand as a written table: ranking, calendar and panel all read it."""
        return materialize(panel.daily_demand(self.items), "daily_demand")

    @property
    def snapshots(self) -> DataFrame:
        return panel.inventory_snapshots(self.stored_demand, self.cfg)

    @property
    def analysis(self) -> DataFrame:
        return marts.inventory_analysis(self.snapshots, self.cfg)

    @property
    def profitability(self) -> DataFrame:
        return marts.store_profitability(self.daily, self.stores, self.cfg)

    @property
    def correlation(self) -> DataFrame:
        return marts.cross_store_correlation(self.daily)

    @cached_property
    def stored_snapshots(self) -> DataFrame:
        """The panel as a written table, for queries that read it more than once."""
        return materialize(self.snapshots, "inventory_snapshots")

    @property
    def features(self) -> DataFrame:
        frame = features.training_frame(self.stored_snapshots, conform.product_prices(self.lines), self.cfg)
        return features.demand_features(frame, self.cfg)

    @property
    def sales(self) -> DataFrame:
        return reporting.sales_summary(self.daily, self.stores)

    @property
    def inventory(self) -> DataFrame:
        return reporting.inventory_summary(self.analysis, self.stores, conform.product_names(self.lines))

    @property
    def performance(self) -> DataFrame:
        return reporting.store_performance(self.profitability, self.stores)

    def policies(self) -> DataFrame:
        """Both policies on the seasonal baseline forecast, so that the result does not depend on a fitted model."""
        test = features.test_rows(self.features, self.cfg)
        opening = policy.opening_stock(self.stored_snapshots, self.cfg)
        return policy.compare_policies(test, "seasonal_naive_pred", opening, self.cfg)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _with_products_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("reference_unit_price", F.round(F.col("reference_unit_price").cast("double"), 6))


# -- conform --------------------------------------------------------------------------------------


def q_clean(spark, sf):
    return clean_transactions(sales_log(spark, sf))


def q_routed(spark, sf):
    return Workspace(spark, sf).routed.select("invoice_no", "line_no", "stock_code", "customer_id", "country", "store_id")


def q_routing_share(spark, sf):
    w = Workspace(spark, sf)
    return w.routed.groupBy("store_id").agg(F.count("*").alias("lines"), F.sum("quantity").alias("units"))


def q_validation_report(spark, sf):
    return Workspace(spark, sf).validation.report_frame()


def q_quarantine(spark, sf):
    marked = Workspace(spark, sf).validation.quarantined
    return marked.select("invoice_no", "stock_code", "line_no", "unit_price", F.array_join("violations", ",").alias("violations"))


def q_products(spark, sf):
    return _with_products_as_double(Workspace(spark, sf, described=True).products)


def q_products_by_type(spark, sf):
    return _with_products_as_double(Workspace(spark, sf, "type").products)


def q_orders(spark, sf):
    return Workspace(spark, sf).orders


def q_order_items(spark, sf):
    return Workspace(spark, sf).items


# -- panel ----------------------------------------------------------------------------------------


def q_daily_demand(spark, sf):
    return panel.daily_demand(Workspace(spark, sf).items)


def q_top_products(spark, sf):
    return panel.top_products(Workspace(spark, sf).items, CFG, units="quantity")


def q_top_products_per_store(spark, sf):
    cfg = replace(CFG, top_n_per_store=True)
    return panel.top_products(Workspace(spark, sf).items, cfg, units="quantity")


def q_demand_panel(spark, sf):
    return panel.demand_panel(Workspace(spark, sf, "type").stored_demand, CFG)


def q_inventory_by_stretches(spark, sf):
    """The snapshots again, with series replayed in stretches side by side."""
    return panel.inventory_snapshots(Workspace(spark, sf, "type").stored_demand, CFG, stretches=True)


def q_inventory_snapshots(spark, sf):
    return Workspace(spark, sf, "type").snapshots


def q_inventory_analysis(spark, sf):
    return rounded(
        Workspace(spark, sf).analysis, "avg_daily_demand", "avg_stock_on_hand", "days_of_supply", "turnover_ratio"
    )


def q_panel_overview(spark, sf):
    return rounded(panel.panel_overview(Workspace(spark, sf).snapshots), "pct_zero")


# -- marts ----------------------------------------------------------------------------------------


def q_store_daily_metrics(spark, sf):
    return Workspace(spark, sf).daily


def q_store_profitability(spark, sf):
    return Workspace(spark, sf).profitability


def q_cross_store_correlation(spark, sf):
    return rounded(Workspace(spark, sf).correlation, "weekly_revenue_correlation")


# -- forecast -------------------------------------------------------------------------------------


def q_dense_pairs(spark, sf):
    return rounded(features.select_dense_pairs(Workspace(spark, sf, "type").snapshots, CFG), "density")


def q_dense_pairs_by_store(spark, sf):
    pairs = features.select_dense_pairs(Workspace(spark, sf, "type").snapshots, CFG)
    return reporting.value_counts(pairs, "store_id")


def q_training_frame(spark, sf):
    w = Workspace(spark, sf, "type", shared=True)
    return rounded(features.training_frame(w.stored_snapshots, conform.product_prices(w.lines), CFG), "reference_unit_price")


def q_demand_features(spark, sf):
    return rounded(
        Workspace(spark, sf, "type", shared=True).features,
        "reference_unit_price",
        "rolling_mean_7",
        "rolling_std_7",
        "seasonal_naive_pred",
    )


def q_forecast_split(spark, sf):
    rows = Workspace(spark, sf, "type", shared=True).features
    return forecast.run_summary(features.train_rows(rows, CFG), features.test_rows(rows, CFG))


def q_seasonal_naive_eval(spark, sf):
    test = features.test_rows(Workspace(spark, sf, "type", shared=True).features, CFG)
    predictions = forecast.stack_predictions(test, {CFG.baseline_name: "seasonal_naive_pred"})
    return rounded(forecast.evaluate_forecast(predictions), "mae", "rmse")


def q_stacked_predictions(spark, sf):
    """The seasonal baseline and the trailing mean as two models' predictions."""
    test = features.test_rows(Workspace(spark, sf, "type", shared=True).features, CFG)
    names = {CFG.baseline_name: "seasonal_naive_pred", "trailing_week_mean": "rolling_mean_7"}
    return rounded(forecast.stack_predictions(test, names), "predicted_demand")


def fit_demand_model(spark, sf, w: Workspace | None = None):
    """The model fitted on the training rows, and the test rows; of the workspace, if there is one."""
    rows = materialize((w or Workspace(spark, sf, "type", shared=True)).features, "demand_features")
    return forecast.train_forecast(features.train_rows(rows, CFG), CFG), features.test_rows(rows, CFG)


def _scored(spark, sf, w: Workspace | None = None):
    """The test rows with the prediction of a model fitted for them."""
    model, test = fit_demand_model(spark, sf, w)
    return materialize(forecast.predict(model, test), "scored")


def _only(name: str, column: str) -> Column:
    """The column on the baseline's rows, NULL on the model's, whose figures no other engine can repeat."""
    return F.when(F.col("model_name") == name, F.round(column, 6)).alias(column)


def q_busiest_pair(spark, sf):
    """Actual demand, the baseline and whether the model has a usable prediction."""
    series = forecast.busiest_pair_series(_scored(spark, sf), CFG)
    usable = F.coalesce(F.col(forecast.PREDICTION) >= 0, F.lit(False)).alias("model_usable")
    return rounded(
        series.select("store_id", "stock_code", "snapshot_date", "units_demanded", "seasonal_naive_pred", usable),
        "seasonal_naive_pred",
    )


def q_forecast_predictions(spark, sf):
    """Both models' stored predictions: the baseline's values, and for either whether the value is usable."""
    stacked = forecast.stack_predictions(_scored(spark, sf), _MODELS)
    usable = F.coalesce(F.col(forecast.PREDICTION) >= 0, F.lit(False)).alias("usable")
    kept = _only(CFG.baseline_name, forecast.PREDICTION)
    return stacked.select("store_id", "stock_code", "snapshot_date", "model_name", "actual_demand", kept, usable)


def q_forecast_evaluation(spark, sf):
    """Both models' errors: the baseline's values, and whether the metrics agree with the rows they stand for."""
    stacked = forecast.stack_predictions(_scored(spark, sf), _MODELS)
    gap = F.col("actual_demand") - F.col(forecast.PREDICTION)
    again = stacked.groupBy("model_name").agg(
        F.count("*").alias("n"), F.sum(F.abs(gap)).alias("total"), F.sum(gap * gap).alias("squares")
    )
    joined = forecast.evaluate_forecast(stacked).join(again, "model_name")
    agrees = (F.abs(F.col("mae") - F.col("total") / F.col("n")) < 1e-9) & (
        F.abs(F.col("rmse") - F.sqrt(F.col("squares") / F.col("n"))) < 1e-9
    )
    sound = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae")) & agrees
    return joined.select("model_name", "n", *(_only(CFG.baseline_name, c) for c in ("mae", "rmse")), sound.alias("sound"))


def q_one_hot_positions(spark, sf):
    """The one-hot position of every store, as fitted on the training rows: most rows first, ties by name."""
    rows = materialize(Workspace(spark, sf, "type", shared=True).features, "demand_features")
    train = features.train_rows(rows, CFG)
    stages = Pipeline(stages=forecast.feature_stages(CFG)).fit(train)
    stores = rows.select(*CFG.numeric_features, *CFG.categorical_features).dropDuplicates(["store_id"])
    vector = vector_to_array("store_id_vector")
    return stages.transform(stores).select("store_id", F.array_position(vector, F.lit(1.0)).cast("int").alias("position"))


def q_ranked_models(spark, sf):
    """Two baselines ranked by their error."""
    w = Workspace(spark, sf, "type", shared=True)
    names = {CFG.baseline_name: "seasonal_naive_pred", "trailing_week_mean": "rolling_mean_7"}
    predictions = forecast.stack_predictions(features.test_rows(w.features, CFG), names)
    scores = forecast.evaluate_forecast(predictions).withColumnRenamed("model_name", "model_id")
    return rounded(forecast.rank_models(scores), "mae", "rmse")


def q_leaderboard(spark, sf):
    """The board of the model search; for the figures, what holds for any fit: ranked by error, sound, one leader."""
    rows = materialize(Workspace(spark, sf, "type", shared=True).features, "demand_features")
    board = forecast.model_search(features.train_rows(rows, CFG), CFG, RUN_TS).leaderboard
    before, after = (f("mae").over(Window.orderBy("rank")) for f in (F.lag, F.lead))  # one row per candidate
    ordered = F.coalesce(F.col("mae") >= before, F.lit(True)) & F.coalesce(F.col("mae") <= after, F.lit(True))
    leads = F.col("is_leader") == (F.col("rank") == 1)
    sound = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae")) & (F.abs(F.col("rmse") ** 2 - F.col("mse")) < 1e-6)
    flags = [ordered.alias("ordered"), leads.alias("leads"), sound.alias("sound")]
    return board.select("model_id", "algorithm", *flags, "target_column", "project_name")


_BASELINES = [
    forecast.Candidate("seasonal", "Baseline", stacking.ColumnForecast("seasonal_naive_pred")),
    forecast.Candidate("weekly_mean", "Baseline", stacking.ColumnForecast("rolling_mean_7")),
]


def _baselines_out_of_fold(spark, sf):
    rows = features.train_rows(Workspace(spark, sf, "type", shared=True).features, CFG)
    return stacking.out_of_fold(rows, CFG, _BASELINES)


def q_out_of_fold(spark, sf):
    """The days of the rolling folds with both baselines' forecasts."""
    return rounded(_baselines_out_of_fold(spark, sf), "seasonal", "weekly_mean")


def q_stacked_baselines(spark, sf):
    """Per model the error over all folds, of the baselines and of their non-negative combination, and the final weights."""
    found = _baselines_out_of_fold(spark, sf)
    scores = stacking.score_candidates(found, _BASELINES, 3).select("model_id", "algorithm", "mae", "rmse")
    weights = stacking.stack_weights(found, [c.model_id for c in _BASELINES])
    weight = F.lit(None).cast("double")
    for name, value in weights.items():
        weight = F.when(F.col("model_id") == name, F.lit(value)).otherwise(weight)
    return rounded(scores.withColumn("weight", weight), "mae", "rmse", "weight")


# -- policies -------------------------------------------------------------------------------------


def q_opening_stock(spark, sf):
    return policy.opening_stock(Workspace(spark, sf, "type").snapshots, CFG)


def q_policy_comparison(spark, sf):
    return rounded(Workspace(spark, sf, "type", shared=True).policies(), "avg_stock_on_hand")


def q_policy_totals(spark, sf):
    totals = policy.policy_totals(Workspace(spark, sf, "type", shared=True).policies(), CFG)
    return rounded(totals, "avg_stockout_days", "avg_stock_on_hand")


def q_policy_pivot(spark, sf):
    wide = policy.policy_pivot(Workspace(spark, sf, "type", shared=True).policies(), CFG)
    return rounded(wide, CFG.fixed_policy, CFG.forecast_policy, "stock_change")


def q_policy_change(spark, sf):
    wide = policy.policy_pivot(Workspace(spark, sf, "type", shared=True).policies(), CFG)
    return rounded(policy.policy_change_summary(wide), "median_stock_change", "share_lower")


def q_policy_largest_increases(spark, sf):
    wide = policy.policy_pivot(Workspace(spark, sf, "type", shared=True).policies(), CFG)
    return rounded(policy.largest_increases(wide), CFG.fixed_policy, CFG.forecast_policy, "stock_change")


def q_restock_distribution(spark, sf):
    test = features.test_rows(Workspace(spark, sf, "type", shared=True).features, CFG)
    spread = policy.restock_distribution(test, "seasonal_naive_pred", CFG)
    return rounded(spread, "mean", "std", "p25", "p50", "p75", "share_below_par")


def q_policy_with_model(spark, sf):
    """Both policies on the model's stored forecast: the fixed policy's figures, and whether the other's are sound."""
    scored = _scored(spark, sf)
    stacked = forecast.stack_predictions(scored, _MODELS)
    test = policy.with_stored_forecast(scored.drop(forecast.PREDICTION), stacked, CFG.model_name)
    opening = policy.opening_stock(Workspace(spark, sf, "type").stored_snapshots, CFG)
    found = policy.compare_policies(test, forecast.PREDICTION, opening, CFG)
    fixed = F.col("policy_name") == CFG.fixed_policy
    sound = (F.col("stockout_days") >= 0) & (F.col("avg_stock_on_hand") >= 0)
    return found.select(
        "store_id",
        "stock_code",
        "policy_name",
        F.when(fixed, F.col("stockout_days")).alias("stockout_days"),
        F.when(fixed, F.round("avg_stock_on_hand", 6)).alias("avg_stock_on_hand"),
        sound.alias("sound"),
    )


def q_restock_with_model(spark, sf):
    """The distribution of the model's restock levels: their number, and whether its figures are in order."""
    spread = policy.restock_distribution(_scored(spark, sf), forecast.PREDICTION, CFG)
    ordered = (F.col("min") <= F.col("p25")) & (F.col("p25") <= F.col("p50")) & (F.col("p50") <= F.col("p75"))
    sound = ordered & (F.col("p75") <= F.col("max")) & (F.col("min") >= 0) & F.col("share_below_par").between(0, 1)
    return spread.select("count", sound.alias("sound"))


def q_restock_from_predictions(spark, sf):
    """Restock levels from one model's stored predictions, read back and joined to the test rows."""
    test = features.test_rows(Workspace(spark, sf, "type", shared=True).features, CFG)
    names = {CFG.baseline_name: "seasonal_naive_pred", "trailing_week_mean": "rolling_mean_7"}
    joined = policy.with_stored_forecast(test, forecast.stack_predictions(test, names), "trailing_week_mean")
    level = policy.restock_level(F.col("predicted_demand"), F.col("rolling_std_7"), CFG)
    return joined.select("store_id", "stock_code", "snapshot_date", level.alias("restock_level"))


# -- views, measures, dashboard -------------------------------------------------------------------


def q_sales_summary(spark, sf):
    return Workspace(spark, sf).sales


def q_inventory_summary(spark, sf):
    found = Workspace(spark, sf, shared=True, described=True).inventory
    return rounded(found, "avg_daily_demand", "avg_stock_on_hand", "days_of_supply", "turnover_ratio")


def q_store_performance(spark, sf):
    return Workspace(spark, sf).performance


def q_headline_figures(spark, sf):
    w = Workspace(spark, sf)
    daily = w.stored_daily
    sales = reporting.sales_summary(daily, w.stores)
    performance = reporting.store_performance(marts.store_profitability(daily, w.stores, CFG), w.stores)
    return rounded(reporting.headline_figures(sales, performance), "avg_order_value")


def q_sales_measures_by_store(spark, sf):
    found = reporting.measures(
        Workspace(spark, sf).sales, ["total_revenue", "total_orders", "avg_order_value"], ["store_name"]
    )
    return rounded(found, "avg_order_value")


def q_revenue_by_region(spark, sf):
    return reporting.measures(Workspace(spark, sf).sales, ["total_revenue"], ["region"])


def q_revenue_by_day(spark, sf):
    return reporting.measures(Workspace(spark, sf).sales, ["total_revenue"], ["metric_date"])


def q_inventory_measures_by_store(spark, sf):
    names = ["avg_turnover_ratio", "total_stockout_days", "avg_days_of_supply"]
    found = reporting.measures(Workspace(spark, sf, shared=True, described=True).inventory, names, ["store_name"])
    return rounded(found, "avg_turnover_ratio", "avg_days_of_supply")


SALES_PAGE = {"cards": (), "by_store": ("store_name",), "by_region": ("region",), "by_day": ("metric_date",), "stores": ("region", "store_name")}
SALES_MEASURES = ("total_revenue", "total_orders", "avg_order_value")


def q_sales_page(spark, sf):
    """Every visual of the sales pages from one aggregate."""
    return rounded(reporting.page(Workspace(spark, sf).sales, SALES_PAGE, SALES_MEASURES), "avg_order_value")


def q_sliced_sales_page(spark, sf):
    """The same under a store slicer."""
    picked = F.col("store_name").isin("London Dark Store", "Dublin Dark Store")
    return rounded(reporting.page(Workspace(spark, sf).sales, SALES_PAGE, SALES_MEASURES, picked), "avg_order_value")


def q_profit_measures_by_store(spark, sf):
    found = reporting.measures(Workspace(spark, sf).performance, ["total_profit", "avg_roi_pct"], ["store_name"])
    return rounded(found, "avg_roi_pct")


def q_revenue_by_month(spark, sf):
    return reporting.measures(Workspace(spark, sf).performance, ["total_revenue"], ["month"])


def q_inventory_detail(spark, sf):
    columns = ["store_name", "stock_code", "description", "days_of_supply", "turnover_ratio"]
    found = Workspace(spark, sf, shared=True, described=True).inventory
    return rounded(found.select(*columns), "days_of_supply", "turnover_ratio")


def q_sliced_revenue(spark, sf):
    """Revenue per store under a store slicer."""
    w = Workspace(spark, sf)
    kept = reporting.slice_stores(w.sales, w.stores, ["London Dark Store", "Dublin Dark Store"])
    return reporting.measures(kept, ["total_revenue"], ["store_name"])


def q_dashboard_totals(spark, sf):
    w = Workspace(spark, sf)
    return reporting.dashboard_totals(w.daily, w.stores, ["London Dark Store", "Amsterdam Dark Store"])


def q_weekly_revenue(spark, sf):
    w = Workspace(spark, sf)
    return reporting.weekly_revenue(w.daily, w.stores)


def q_inventory_health_by_store(spark, sf):
    w = Workspace(spark, sf)
    return reporting.inventory_health_by_store(w.analysis, w.stores)


def q_inventory_health_report(spark, sf):
    return reporting.relabel(q_inventory_health_by_store(spark, sf), reporting.INVENTORY_TITLES)


def q_worst_stockouts(spark, sf):
    w = Workspace(spark, sf)
    return reporting.worst_stockouts(w.analysis, w.stores)


def q_profit_months(spark, sf):
    return reporting.profit_months(Workspace(spark, sf).profitability)


def q_profit_ranking(spark, sf):
    w = Workspace(spark, sf)
    return reporting.profit_ranking(marts.store_profitability(w.stored_daily, w.stores, CFG), w.stores)


def q_profit_report(spark, sf):
    return reporting.relabel(q_profit_ranking(spark, sf), reporting.PROFIT_TITLES)


def q_correlation_report(spark, sf):
    return reporting.relabel(q_correlation_listing(spark, sf), reporting.CORRELATION_TITLES)


def q_profitability_detail(spark, sf):
    columns = ["store_name", "month", "revenue", "cogs_estimate", "opex_estimate", "profit_estimate", "roi_pct"]
    return Workspace(spark, sf).performance.select(*columns)


def q_correlation_listing(spark, sf):
    w = Workspace(spark, sf)
    return reporting.correlation_listing(w.correlation, w.stores)


# -- checks and upserts ---------------------------------------------------------------------------


def _items_before_validation(w: Workspace) -> DataFrame:
    """Items of all routed lines: those of invoices that are quarantined completely have no order header."""
    return conform.build_order_items(w.routed, w.cfg)


def q_orphan_items(spark, sf):
    w = Workspace(spark, sf)
    return constraints.orphan_items(_items_before_validation(w), w.orders)


def q_foreign_key_check(spark, sf):
    w = Workspace(spark, sf)
    return constraints.check_foreign_key(_items_before_validation(w), w.orders, "invoice_no")


def q_primary_key_check(spark, sf):
    """Order lines repeat (invoice, product) before they are summed into items."""
    return constraints.check_primary_key(Workspace(spark, sf).lines, TABLES["order_items"].keys)


def q_constraint_report(spark, sf):
    w = Workspace(spark, sf)
    parents = {"orders": w.orders, "stores": w.stores}
    items = materialize(_items_before_validation(w), "order_items")
    return constraints.constraint_report(TABLES["order_items"], items, parents)


def q_quality_report(spark, sf):
    """The gates of a run, over the model's and the baseline's metrics."""
    w = Workspace(spark, sf, "type", shared=True, stored_items=True)
    evaluation = forecast.evaluate_forecast(forecast.stack_predictions(_scored(spark, sf, w), _MODELS))
    return constraints.quality_report(w.items, w.orders, w.daily, materialize(evaluation, "model_evaluation"), CFG)


def q_status_rules(spark, sf):
    """Counts per rule of a rule set with allowed values, ranges and required columns over the order lines."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    rules = Rules(
        required_columns=("l_orderkey", "l_returnflag", "l_linestatus"),
        not_null_columns=("l_orderkey",),
        numeric_ranges={"l_discount": (0.0, 0.05)},
        allowed_values={"l_returnflag": ("N", "R"), "l_linestatus": ("F", "O")},
    )
    return validate(lines, rules).report_frame()


def q_workbook_log(spark, sf):
    """The log written as spreadsheet workbooks and read back from them."""
    folder = scratch_path(spark, "workbooks")
    log = sales_log(spark, sf, "part")
    named = log.withColumnsRenamed({name: header for header, name in LOG_HEADERS.items()})
    register(spark)
    named.write.format("workbook").mode("overwrite").save(folder)
    return load_transactions(spark, folder, "workbook", line_column="line_no", rows_per_partition="25000")


def q_upsert_merge(spark, sf):
    """Daily metrics up to 2000 upserted with the recomputed metrics from mid-1999 on."""
    daily = Workspace(spark, sf).stored_daily
    old = daily.where(F.col("metric_date") < F.lit(date(2000, 1, 1))).withColumn("orders_count", F.lit(0).cast("bigint"))
    new = daily.where(F.col("metric_date") >= F.lit(date(1999, 7, 1)))
    return merge_rows(old, new, TABLES["store_daily_metrics"].keys)


def q_upsert_partial_columns(spark, sf):
    """The same with a batch that carries one measure only: the other columns keep their value or stay empty."""
    daily = Workspace(spark, sf).stored_daily
    old = daily.where(F.col("metric_date") < F.lit(date(2000, 1, 1)))
    new = daily.where(F.col("metric_date") >= F.lit(date(1999, 7, 1))).select(
        "store_id", "metric_date", (F.col("units_sold") * 2).alias("units_sold")
    )
    return merge_rows(old, new, TABLES["store_daily_metrics"].keys)


def q_last_price(spark, sf):
    """The last line of every invoice and product wins: the row-mode rule for repeated keys."""
    lines = Workspace(spark, sf).lines.select("invoice_no", "stock_code", "quantity", "unit_price", "line_no")
    return keep_last(lines, ["invoice_no", "stock_code"], F.col("line_no")).select("invoice_no", "stock_code", "unit_price")


QUERIES: dict[str, Query] = {
    "clean_transactions": q_clean,
    "route_orders": q_routed,
    "routing_share": q_routing_share,
    "validation_report": q_validation_report,
    "quarantine": q_quarantine,
    "products": q_products,
    "products_by_type": q_products_by_type,
    "orders": q_orders,
    "order_items": q_order_items,
    "daily_demand": q_daily_demand,
    "top_products": q_top_products,
    "top_products_per_store": q_top_products_per_store,
    "demand_panel": q_demand_panel,
    "inventory_snapshots": q_inventory_snapshots,
    "inventory_by_stretches": q_inventory_by_stretches,
    "inventory_analysis": q_inventory_analysis,
    "panel_overview": q_panel_overview,
    "store_daily_metrics": q_store_daily_metrics,
    "store_profitability": q_store_profitability,
    "cross_store_correlation": q_cross_store_correlation,
    "dense_pairs": q_dense_pairs,
    "dense_pairs_by_store": q_dense_pairs_by_store,
    "training_frame": q_training_frame,
    "demand_features": q_demand_features,
    "forecast_split": q_forecast_split,
    "seasonal_naive_eval": q_seasonal_naive_eval,
    "stacked_predictions": q_stacked_predictions,
    "busiest_pair": q_busiest_pair,
    "forecast_predictions": q_forecast_predictions,
    "forecast_evaluation": q_forecast_evaluation,
    "ranked_models": q_ranked_models,
    "leaderboard": q_leaderboard,
    "out_of_fold": q_out_of_fold,
    "stacked_baselines": q_stacked_baselines,
    "opening_stock": q_opening_stock,
    "policy_comparison": q_policy_comparison,
    "policy_totals": q_policy_totals,
    "policy_pivot": q_policy_pivot,
    "policy_change": q_policy_change,
    "policy_largest_increases": q_policy_largest_increases,
    "restock_distribution": q_restock_distribution,
    "one_hot_positions": q_one_hot_positions,
    "policy_with_model": q_policy_with_model,
    "restock_with_model": q_restock_with_model,
    "restock_from_predictions": q_restock_from_predictions,
    "sales_summary": q_sales_summary,
    "inventory_summary": q_inventory_summary,
    "store_performance": q_store_performance,
    "headline_figures": q_headline_figures,
    "sales_measures_by_store": q_sales_measures_by_store,
    "sales_page": q_sales_page,
    "sliced_sales_page": q_sliced_sales_page,
    "revenue_by_region": q_revenue_by_region,
    "revenue_by_day": q_revenue_by_day,
    "inventory_measures_by_store": q_inventory_measures_by_store,
    "profit_measures_by_store": q_profit_measures_by_store,
    "revenue_by_month": q_revenue_by_month,
    "inventory_detail": q_inventory_detail,
    "sliced_revenue": q_sliced_revenue,
    "dashboard_totals": q_dashboard_totals,
    "weekly_revenue": q_weekly_revenue,
    "inventory_health_by_store": q_inventory_health_by_store,
    "worst_stockouts": q_worst_stockouts,
    "profit_months": q_profit_months,
    "profit_ranking": q_profit_ranking,
    "correlation_listing": q_correlation_listing,
    "inventory_health_report": q_inventory_health_report,
    "profit_report": q_profit_report,
    "profitability_detail": q_profitability_detail,
    "correlation_report": q_correlation_report,
    "orphan_items": q_orphan_items,
    "foreign_key_check": q_foreign_key_check,
    "primary_key_check": q_primary_key_check,
    "constraint_report": q_constraint_report,
    "quality_report": q_quality_report,
    "upsert_merge": q_upsert_merge,
    "upsert_partial_columns": q_upsert_partial_columns,
    "last_price": q_last_price,
    "status_rules": q_status_rules,
    "workbook_log": q_workbook_log,
}
