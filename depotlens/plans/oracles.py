"""The same questions in plain SQL over the same whole tables, written independently of the operators.

Each statement names the common table expressions it needs; ``sql`` puts them in front.
"""

from __future__ import annotations

CTES: dict[str, str] = {}

_LOG = """
log AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || l_orderkey::VARCHAR AS invoice_no,
         {product} AS stock_code, p_name AS description, l_quantity::INTEGER AS quantity,
         o_orderdate + to_hours(l_linenumber) AS invoice_date,
         l_extendedprice::DECIMAL(18,2)::DECIMAL(18,4) AS unit_price, o_custkey AS customer_id,
         CASE r_name WHEN 'ASIA' THEN 'United Kingdom' WHEN 'EUROPE' THEN 'Germany' WHEN 'AMERICA' THEN 'EIRE'
                     ELSE n_name END AS country,
         ((l_linenumber::BIGINT * 100000 + date_diff('day', DATE '1970-01-01', l_shipdate::DATE)) * 100
           + l_quantity::BIGINT) * 100000000 + (l_extendedprice::DECIMAL(18,2) * 100)::BIGINT AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey
)"""
CTES["log_part"] = _LOG.format(product="l_partkey::VARCHAR")
CTES["log_type"] = _LOG.format(product="p_type")
CTES["lines"] = """
clean AS (
  SELECT * FROM log WHERE NOT starts_with(invoice_no, 'C') AND quantity > 0 AND unit_price > 0 AND stock_code IS NOT NULL
),
routed AS (
  SELECT *, CASE WHEN country = 'United Kingdom' THEN
              (['LON', 'MAN', 'EDI'])[1 + (('0x' || substr(md5(customer_id::VARCHAR), 1, 8))::BIGINT
                + ('0x' || substr(md5(customer_id::VARCHAR), 9, 8))::BIGINT
                + ('0x' || substr(md5(customer_id::VARCHAR), 17, 8))::BIGINT
                + ('0x' || substr(md5(customer_id::VARCHAR), 25, 8))::BIGINT) % 3]
            WHEN country = 'EIRE' THEN 'DUB' WHEN country = 'Germany' THEN 'AMS' ELSE 'FAR' END AS store_id
  FROM clean
),
lines AS (SELECT * FROM routed WHERE quantity BETWEEN 1 AND 100000 AND unit_price BETWEEN 0.001 AND 100000)"""
CTES["items"] = """
items AS (
  SELECT invoice_no, stock_code, store_id, sum(quantity)::BIGINT AS quantity, arg_min(unit_price, line_no) AS unit_price,
         (sum(quantity)::BIGINT * arg_min(unit_price, line_no))::DECIMAL(18,2) AS revenue,
         min(invoice_date)::DATE AS order_date
  FROM lines GROUP BY ALL
)"""
CTES["orders_built"] = """
orders_built AS (
  SELECT invoice_no, arg_min(store_id, line_no) AS store_id, min(invoice_date) AS order_date,
         arg_min(customer_id, line_no)::VARCHAR AS customer_id, arg_min(country, line_no) AS country
  FROM lines GROUP BY invoice_no
)"""
CTES["routed_items"] = CTES["items"].replace("items AS", "routed_items AS").replace("FROM lines", "FROM routed")
CTES["headers"] = "headers AS (SELECT DISTINCT invoice_no FROM lines)"
CTES["products"] = """
named AS (
  SELECT stock_code, description,
         row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description) AS pick
  FROM lines WHERE description IS NOT NULL GROUP BY stock_code, description
),
priced AS (SELECT stock_code, median(unit_price::DOUBLE) AS reference_unit_price FROM lines GROUP BY stock_code),
products AS (
  SELECT p.stock_code, n.description, p.reference_unit_price
  FROM priced p LEFT JOIN named n ON n.stock_code = p.stock_code AND n.pick = 1
)"""
CTES["stores"] = """
stores(store_id, name, region, country, sqft) AS (VALUES
  ('LON', 'London Dark Store', 'Greater London', 'United Kingdom', 8000),
  ('MAN', 'Manchester Dark Store', 'North West England', 'United Kingdom', 6500),
  ('EDI', 'Edinburgh Dark Store', 'Scotland', 'United Kingdom', 5000),
  ('DUB', 'Dublin Dark Store', 'Leinster', 'Ireland', 4500),
  ('AMS', 'Amsterdam Dark Store', 'North Holland', 'Netherlands', 7000),
  ('FAR', 'Global Fallback Fulfillment', 'N/A', 'N/A', 3000))"""
CTES["daily"] = """
daily AS (
  SELECT store_id, order_date AS metric_date, sum(revenue)::DECIMAL(28,2) AS revenue,
         count(DISTINCT invoice_no) AS orders_count, sum(quantity)::BIGINT AS units_sold
  FROM items GROUP BY store_id, order_date
)"""
CTES["profit"] = """
monthly AS (
  SELECT d.store_id, date_trunc('month', metric_date)::DATE AS month, sum(revenue)::DECIMAL(28,2) AS revenue,
         any_value(sqft) * 4 AS opex
  FROM daily d JOIN stores USING (store_id) GROUP BY 1, 2
),
costed AS (SELECT *, (revenue * 0.58 - opex)::DECIMAL(30,4) AS profit FROM monthly),
profit AS (
  SELECT store_id, month, revenue, round(revenue * 0.42, 2)::DECIMAL(28,2) AS cogs_estimate,
         opex::DECIMAL(28,2) AS opex_estimate, round(profit, 2)::DECIMAL(28,2) AS profit_estimate,
         (sign(profit) * ((2 * abs((profit * 10000)::HUGEINT) + opex) // (2 * opex)))::DOUBLE / 100 AS roi_pct
  FROM costed
)"""
CTES["correlation"] = """
weekly AS (
  SELECT store_id, date_trunc('week', metric_date)::DATE AS week, sum(revenue)::DOUBLE AS revenue FROM daily GROUP BY 1, 2
),
correlation AS (
  SELECT a.store_id AS store_id_a, b.store_id AS store_id_b,
         CASE WHEN isnan(corr(a.revenue, b.revenue)) THEN NULL ELSE corr(a.revenue, b.revenue) END AS r
  FROM weekly a JOIN weekly b ON a.week = b.week AND a.store_id < b.store_id GROUP BY 1, 2
)"""
# The stock changes on days with demand only, so the replay runs over those days and is carried forward.
CTES["snapshots"] = """
demand AS (
  SELECT store_id, stock_code, order_date AS snapshot_date, sum(quantity)::BIGINT AS units_demanded FROM items GROUP BY 1, 2, 3
),
best AS (
  SELECT stock_code FROM demand GROUP BY stock_code ORDER BY sum(units_demanded) DESC, stock_code LIMIT 150
),
scoped AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, stock_code ORDER BY snapshot_date) AS k
  FROM demand WHERE stock_code IN (SELECT stock_code FROM best)
),
calendar AS (
  SELECT unnest(generate_series((SELECT min(snapshot_date) FROM scoped), (SELECT max(snapshot_date) FROM scoped), INTERVAL 1 DAY))::DATE AS snapshot_date
),
panel AS (
  SELECT p.store_id, p.stock_code, c.snapshot_date, coalesce(s.units_demanded, 0)::BIGINT AS units_demanded
  FROM (SELECT DISTINCT store_id, stock_code FROM scoped) p CROSS JOIN calendar c
       LEFT JOIN scoped s ON s.store_id = p.store_id AND s.stock_code = p.stock_code AND s.snapshot_date = c.snapshot_date
),
replay(store_id, stock_code, snapshot_date, k, stock, event) AS (
  SELECT store_id, stock_code, snapshot_date, k,
         CASE WHEN 300 - units_demanded <= 0 THEN 300 ELSE 300 - units_demanded END, 300 - units_demanded <= 0
  FROM scoped WHERE k = 1
  UNION ALL
  SELECT s.store_id, s.stock_code, s.snapshot_date, s.k,
         CASE WHEN r.stock - s.units_demanded <= 0 THEN 300 ELSE r.stock - s.units_demanded END,
         r.stock - s.units_demanded <= 0
  FROM replay r JOIN scoped s ON s.store_id = r.store_id AND s.stock_code = r.stock_code AND s.k = r.k + 1
),
snapshots AS (
  SELECT p.store_id, p.stock_code, p.snapshot_date, p.units_demanded,
         coalesce(last_value(r.stock IGNORE NULLS) OVER (
           PARTITION BY p.store_id, p.stock_code ORDER BY p.snapshot_date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 300)::BIGINT AS stock_on_hand,
         coalesce(r.event, FALSE) AS restocked
  FROM panel p LEFT JOIN replay r
    ON r.store_id = p.store_id AND r.stock_code = p.stock_code AND r.snapshot_date = p.snapshot_date
)"""
CTES["analysis"] = """
analysis AS (
  SELECT store_id, stock_code, avg(units_demanded) AS avg_daily_demand, avg(stock_on_hand) AS avg_stock_on_hand,
         CASE WHEN avg(units_demanded) > 0 THEN avg(stock_on_hand) / avg(units_demanded) END AS days_of_supply,
         count(*) FILTER (WHERE restocked) AS stockout_days,
         CASE WHEN avg(stock_on_hand) > 0 THEN avg(units_demanded) * 365.0 / avg(stock_on_hand) END AS turnover_ratio
  FROM snapshots GROUP BY store_id, stock_code
)"""
CTES["dense"] = """
dense AS (
  SELECT store_id, stock_code, avg((units_demanded > 0)::INTEGER) AS density
  FROM snapshots WHERE snapshot_date < DATE '2001-06-07' GROUP BY 1, 2 HAVING avg((units_demanded > 0)::INTEGER) >= 0.4
)"""
CTES["frame"] = """
joined AS (
  SELECT s.store_id, s.stock_code, s.snapshot_date, s.units_demanded, s.stock_on_hand, p.reference_unit_price
  FROM snapshots s JOIN dense d ON d.store_id = s.store_id AND d.stock_code = s.stock_code
       LEFT JOIN products p ON p.stock_code = s.stock_code
),
frame AS (
  SELECT * REPLACE (coalesce(reference_unit_price, (SELECT median(reference_unit_price) FROM joined)) AS reference_unit_price)
  FROM joined
)"""
CTES["features"] = """
windowed AS (
  SELECT *, (isodow(snapshot_date) - 1)::INTEGER AS day_of_week,
         lag(units_demanded, 1) OVER w AS lag_1, lag(units_demanded, 7) OVER w AS lag_7,
         lag(units_demanded, 14) OVER w AS lag_14, lag(units_demanded, 21) OVER w AS lag_21,
         lag(units_demanded, 28) OVER w AS lag_28,
         CASE WHEN count(*) OVER prior = 7 THEN avg(units_demanded) OVER prior END AS rolling_mean_7,
         CASE WHEN count(*) OVER prior = 7 THEN stddev_samp(units_demanded) OVER prior END AS rolling_std_7
  FROM frame
  WINDOW w AS (PARTITION BY store_id, stock_code ORDER BY snapshot_date),
         prior AS (PARTITION BY store_id, stock_code ORDER BY snapshot_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
features AS (
  SELECT * EXCLUDE (lag_14, lag_21, lag_28),
         list_avg(list_filter([lag_7, lag_14, lag_21, lag_28], lambda x: x IS NOT NULL)) AS seasonal_naive_pred
  FROM windowed WHERE rolling_mean_7 IS NOT NULL
),
test AS (SELECT * FROM features WHERE snapshot_date >= DATE '2001-06-07')"""
CTES["policies"] = """
opening AS (SELECT store_id, stock_code, stock_on_hand FROM snapshots WHERE snapshot_date = DATE '2001-06-06'),
numbered AS (
  SELECT store_id, stock_code, units_demanded,
         greatest(0, round_even(seasonal_naive_pred * 7.0::DOUBLE + 1.65::DOUBLE * coalesce(rolling_std_7, 0) * sqrt(7.0::DOUBLE), 0))::BIGINT AS level,
         row_number() OVER (PARTITION BY store_id, stock_code ORDER BY snapshot_date) AS k
  FROM test
),
played AS (
  SELECT n.store_id, n.stock_code, p.policy_name, n.k, n.units_demanded,
         CASE WHEN p.policy_name = 'fixed_restock_300' THEN 300 ELSE n.level END::BIGINT AS refill
  FROM numbered n CROSS JOIN (VALUES ('fixed_restock_300'), ('forecast_plus_safety_buffer')) p(policy_name)
),
walk(store_id, stock_code, policy_name, k, stock, event) AS (
  SELECT p.store_id, p.stock_code, p.policy_name, 0::BIGINT, coalesce(o.stock_on_hand, 300)::BIGINT, FALSE
  FROM played p LEFT JOIN opening o ON o.store_id = p.store_id AND o.stock_code = p.stock_code WHERE p.k = 1
  UNION ALL
  SELECT p.store_id, p.stock_code, p.policy_name, p.k,
         CASE WHEN w.stock - p.units_demanded <= 0 THEN p.refill ELSE w.stock - p.units_demanded END,
         w.stock - p.units_demanded <= 0
  FROM walk w JOIN played p ON p.store_id = w.store_id AND p.stock_code = w.stock_code
       AND p.policy_name = w.policy_name AND p.k = w.k + 1
),
policies AS (
  SELECT store_id, stock_code, policy_name, count(*) FILTER (WHERE event) AS stockout_days, avg(stock) AS avg_stock_on_hand
  FROM walk WHERE k > 0 GROUP BY 1, 2, 3
)"""
CTES["wide"] = """
wide AS (
  SELECT store_id, stock_code,
         max(avg_stock_on_hand) FILTER (WHERE policy_name = 'fixed_restock_300') AS fixed_restock_300,
         max(avg_stock_on_hand) FILTER (WHERE policy_name = 'forecast_plus_safety_buffer') AS forecast_plus_safety_buffer
  FROM policies GROUP BY 1, 2
)"""
CTES["sales"] = """
sales AS (
  SELECT d.store_id, s.name AS store_name, s.region, s.country, d.metric_date, d.revenue, d.orders_count, d.units_sold,
         (((2 * (d.revenue * 100)::HUGEINT + d.orders_count) // (2 * d.orders_count))::DECIMAL(30,0)
           * 0.01::DECIMAL(2,2))::DECIMAL(28,2) AS avg_order_value
  FROM daily d JOIN stores s USING (store_id)
)"""
CTES["performance"] = """
performance AS (
  SELECT p.store_id, s.name AS store_name, s.region, s.country, s.sqft, p.month, p.revenue, p.cogs_estimate,
         p.opex_estimate, p.profit_estimate, p.roi_pct
  FROM profit p JOIN stores s USING (store_id)
)"""
CTES["inventory"] = """
inventory AS (
  SELECT a.store_id, s.name AS store_name, a.stock_code, p.description, round(a.avg_daily_demand, 6) AS avg_daily_demand,
         round(a.avg_stock_on_hand, 6) AS avg_stock_on_hand, a.days_of_supply, a.stockout_days, a.turnover_ratio
  FROM analysis a JOIN stores s USING (store_id) LEFT JOIN products p ON p.stock_code = a.stock_code
)"""

LINES = ("log_part", "lines")
ITEMS = (*LINES, "items")
ROUTED = (*LINES, "routed_items")
DAILY = (*ITEMS, "daily")
PROFIT = (*DAILY, "stores", "profit")
PANEL = (*ITEMS, "snapshots")
TYPE_PANEL = ("log_type", "lines", "items", "snapshots")
DENSE = (*TYPE_PANEL, "dense")
CTES["folds"] = """
folds AS (
  SELECT store_id, stock_code, snapshot_date, (date_diff('day', DATE '2001-03-15', snapshot_date) // 28)::INTEGER AS fold,
         units_demanded, seasonal_naive_pred AS seasonal, rolling_mean_7 AS weekly_mean
  FROM features WHERE snapshot_date >= DATE '2001-03-15' AND snapshot_date < DATE '2001-06-07'
)"""
FEATURES = (*DENSE, "products", "frame", "features")
POLICIES = (*FEATURES, "policies")


def sql(ctes: tuple[str, ...], body: str) -> str:
    return "WITH RECURSIVE " + ",".join(CTES[name] for name in ctes) + "\n" + body


_HEALTH = """round(avg_daily_demand, 6) AS avg_daily_demand, round(avg_stock_on_hand, 6) AS avg_stock_on_hand,
  round(days_of_supply, 6) AS days_of_supply, stockout_days, round(turnover_ratio, 6) AS turnover_ratio"""
_WIDE = """SELECT store_id, stock_code, round(fixed_restock_300, 6) AS fixed_restock_300,
  round(forecast_plus_safety_buffer, 6) AS forecast_plus_safety_buffer,
  round(forecast_plus_safety_buffer - fixed_restock_300, 6) AS stock_change FROM wide"""
_FIGURES = """sum(revenue) AS total_revenue, sum(orders_count)::BIGINT AS total_orders,
  round(sum(revenue)::DOUBLE / sum(orders_count), 6) AS avg_order_value FROM sales WHERE {slicer}"""
_PAGE = " UNION ALL ".join(
    f"""SELECT '{visual}' AS visual, {", ".join(f"{c if c in by else f'NULL::{kind}'} AS {c}" for c, kind in
        (("store_name", "VARCHAR"), ("region", "VARCHAR"), ("metric_date", "DATE")))}, {_FIGURES}{" GROUP BY " + ", ".join(by) if by else ""}"""
    for visual, by in (
        ("cards", ()), ("by_store", ("store_name",)), ("by_region", ("region",)), ("by_day", ("metric_date",)), ("stores", ("region", "store_name")),
    )
)
_ORPHANS = "(SELECT count(*) FROM routed_items WHERE invoice_no NOT IN (SELECT invoice_no FROM headers))"

ORACLES: dict[str, str] = {
    "clean_transactions": sql(LINES, "SELECT * FROM clean"),
    "route_orders": sql(LINES, "SELECT invoice_no, line_no, stock_code, customer_id, country, store_id FROM routed"),
    "routing_share": sql(LINES, "SELECT store_id, count(*) AS lines, sum(quantity)::BIGINT AS units FROM routed GROUP BY 1"),
    "validation_report": sql(
        LINES,
        """SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE quantity BETWEEN 1 AND 100000 AND unit_price BETWEEN 0.001 AND 100000) AS valid_rows,
  count(*) FILTER (WHERE NOT (quantity BETWEEN 1 AND 100000 AND unit_price BETWEEN 0.001 AND 100000)) AS invalid_rows,
  count(*) FILTER (WHERE invoice_no IS NULL) AS invoice_no_not_null,
  count(*) FILTER (WHERE stock_code IS NULL) AS stock_code_not_null,
  count(*) FILTER (WHERE store_id IS NULL) AS store_id_not_null,
  count(*) FILTER (WHERE quantity NOT BETWEEN 1 AND 100000) AS quantity_in_range,
  count(*) FILTER (WHERE unit_price NOT BETWEEN 0.001 AND 100000) AS unit_price_in_range FROM routed""",
    ),
    "quarantine": sql(
        LINES,
        """SELECT invoice_no, stock_code, line_no, unit_price, concat_ws(',',
  CASE WHEN quantity NOT BETWEEN 1 AND 100000 THEN 'quantity_in_range' END,
  CASE WHEN unit_price NOT BETWEEN 0.001 AND 100000 THEN 'unit_price_in_range' END) AS violations
FROM routed WHERE quantity NOT BETWEEN 1 AND 100000 OR unit_price NOT BETWEEN 0.001 AND 100000""",
    ),
    "products": sql(
        (*LINES, "products"),
        "SELECT stock_code, description, round(reference_unit_price, 6) AS reference_unit_price FROM products",
    ),
    "products_by_type": sql(
        ("log_type", "lines", "products"),
        "SELECT stock_code, description, round(reference_unit_price, 6) AS reference_unit_price FROM products",
    ),
    "orders": sql((*LINES, "orders_built"), "SELECT * FROM orders_built"),
    "order_items": sql(ITEMS, "SELECT * FROM items"),
    "daily_demand": sql(
        ITEMS,
        "SELECT store_id, stock_code, order_date AS snapshot_date, sum(quantity)::BIGINT AS units_demanded FROM items GROUP BY 1, 2, 3",
    ),
    "top_products": sql(
        ITEMS,
        "SELECT stock_code, sum(quantity)::BIGINT AS units FROM items GROUP BY 1 ORDER BY units DESC, stock_code LIMIT 150",
    ),
    "top_products_per_store": sql(
        ITEMS,
        """SELECT store_id, stock_code, sum(quantity)::BIGINT AS units FROM items GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY sum(quantity) DESC, stock_code) <= 150""",
    ),
    "demand_panel": sql(TYPE_PANEL, "SELECT * FROM panel"),
    "inventory_snapshots": sql(TYPE_PANEL, "SELECT *, TRUE AS is_synthetic FROM snapshots"),
    "inventory_by_stretches": sql(TYPE_PANEL, "SELECT *, TRUE AS is_synthetic FROM snapshots"),
    "inventory_analysis": sql((*PANEL, "analysis"), f"SELECT store_id, stock_code, {_HEALTH} FROM analysis"),
    "panel_overview": sql(
        PANEL,
        """SELECT count(*) AS total_rows, min(snapshot_date) AS min_date, max(snapshot_date) AS max_date,
  count(DISTINCT store_id) AS n_stores, count(DISTINCT stock_code) AS n_products,
  count(DISTINCT store_id || '/' || stock_code) AS n_pairs,
  round(count(*) FILTER (WHERE units_demanded = 0) * 100.0::DOUBLE / count(*), 6) AS pct_zero FROM snapshots""",
    ),
    "store_daily_metrics": sql(DAILY, "SELECT * FROM daily"),
    "store_profitability": sql(PROFIT, "SELECT * FROM profit"),
    "cross_store_correlation": sql(
        (*DAILY, "correlation"),
        "SELECT store_id_a, store_id_b, round(r, 6) AS weekly_revenue_correlation FROM correlation",
    ),
    "dense_pairs": sql(DENSE, "SELECT store_id, stock_code, round(density, 6) AS density FROM dense"),
    "dense_pairs_by_store": sql(DENSE, "SELECT store_id, count(*) AS row_count FROM dense GROUP BY 1"),
    "training_frame": sql(
        (*DENSE, "products", "frame"),
        "SELECT * REPLACE (round(reference_unit_price, 6) AS reference_unit_price) FROM frame",
    ),
    "demand_features": sql(
        FEATURES,
        """SELECT * REPLACE (round(reference_unit_price, 6) AS reference_unit_price, round(rolling_mean_7, 6) AS rolling_mean_7,
  round(rolling_std_7, 6) AS rolling_std_7, round(seasonal_naive_pred, 6) AS seasonal_naive_pred) FROM features""",
    ),
    "forecast_split": sql(
        FEATURES,
        """SELECT count(*) FILTER (WHERE snapshot_date < DATE '2001-06-07') AS train_rows,
  count(*) FILTER (WHERE snapshot_date >= DATE '2001-06-07') AS test_rows,
  count(DISTINCT store_id || '/' || stock_code) AS dense_pairs FROM features""",
    ),
    "seasonal_naive_eval": sql(
        FEATURES,
        """SELECT 'seasonal_naive_dow' AS model_name, round(avg(abs(units_demanded - seasonal_naive_pred)), 6) AS mae,
  round(sqrt(avg((units_demanded - seasonal_naive_pred) ** 2)), 6) AS rmse FROM test GROUP BY 1""",
    ),
    "stacked_predictions": sql(
        FEATURES,
        """SELECT store_id, stock_code, snapshot_date, 'seasonal_naive_dow' AS model_name,
  round(seasonal_naive_pred, 6) AS predicted_demand, units_demanded AS actual_demand FROM test
UNION ALL SELECT store_id, stock_code, snapshot_date, 'trailing_week_mean', round(rolling_mean_7, 6), units_demanded FROM test""",
    ),
    "busiest_pair": sql(
        FEATURES,
        """SELECT store_id, stock_code, snapshot_date, units_demanded, round(seasonal_naive_pred, 6) AS seasonal_naive_pred,
  TRUE AS model_usable
FROM test WHERE (store_id, stock_code) = (SELECT (store_id, stock_code) FROM test GROUP BY store_id, stock_code
  ORDER BY sum(units_demanded) DESC, store_id, stock_code LIMIT 1)""",
    ),
    "forecast_predictions": sql(
        FEATURES,
        """SELECT store_id, stock_code, snapshot_date, 'seasonal_naive_dow' AS model_name, units_demanded AS actual_demand,
  round(seasonal_naive_pred, 6) AS predicted_demand, TRUE AS usable FROM test
UNION ALL SELECT store_id, stock_code, snapshot_date, 'boosted_trees_demand_model', units_demanded, NULL, TRUE FROM test""",
    ),
    "forecast_evaluation": sql(
        FEATURES,
        """SELECT 'seasonal_naive_dow' AS model_name, count(*) AS n, round(avg(abs(units_demanded - seasonal_naive_pred)), 6) AS mae,
  round(sqrt(avg((units_demanded - seasonal_naive_pred) ** 2)), 6) AS rmse, TRUE AS sound FROM test HAVING count(*) > 0
UNION ALL SELECT 'boosted_trees_demand_model', count(*), NULL, NULL, TRUE FROM test HAVING count(*) > 0""",
    ),
    "leaderboard": sql(
        FEATURES,
        """SELECT model_id, algorithm, TRUE AS ordered, TRUE AS leads, TRUE AS sound, 'units_demanded' AS target_column,
  'demand_model_search' AS project_name
FROM (VALUES ('gbt_1', 'GBM'), ('nn_1', 'DeepLearning'), ('drf_1', 'DRF'), ('glm_1', 'GLM')) t(model_id, algorithm)
WHERE EXISTS (SELECT 1 FROM features WHERE snapshot_date < DATE '2001-06-07')""",
    ),
    "out_of_fold": sql(
        (*FEATURES, "folds"),
        """SELECT store_id, stock_code, snapshot_date, fold, units_demanded, round(seasonal, 6) AS seasonal, round(weekly_mean, 6) AS weekly_mean
FROM folds""",
    ),
    "stacked_baselines": sql(
        (*FEATURES, "folds"),
        """, sums AS (
  SELECT k, sum(seasonal * seasonal) AS a, sum(seasonal * weekly_mean) AS b, sum(weekly_mean * weekly_mean) AS c,
         sum(seasonal * units_demanded) AS p, sum(weekly_mean * units_demanded) AS q
  FROM folds JOIN (VALUES (1), (2), (3)) t(k) ON fold < k GROUP BY k
), solved AS (
  SELECT *, (c * p - b * q) / (a * c - b * b) AS x, (a * q - b * p) / (a * c - b * b) AS y FROM sums
), weights AS (
  SELECT k, CASE WHEN x <= 0 THEN 0 WHEN y <= 0 THEN greatest(p / a, 0) ELSE x END AS seasonal_weight,
         CASE WHEN x <= 0 THEN greatest(q / c, 0) WHEN y <= 0 THEN 0 ELSE y END AS mean_weight
  FROM solved UNION ALL SELECT 0, 0.5, 0.5
), forecasts AS (
  SELECT units_demanded AS actual, unnest([seasonal, weekly_mean, seasonal_weight * seasonal + mean_weight * weekly_mean]) AS p,
         unnest(['seasonal', 'weekly_mean', 'ensemble_1']) AS model_id
  FROM folds JOIN weights ON fold = k
)
SELECT model_id, CASE model_id WHEN 'ensemble_1' THEN 'StackedEnsemble' ELSE 'Baseline' END AS algorithm,
       round(avg(abs(actual - p)), 6) AS mae, round(sqrt(avg((actual - p) ** 2)), 6) AS rmse,
       round(CASE model_id WHEN 'seasonal' THEN (SELECT seasonal_weight FROM weights WHERE k = 3)
                           WHEN 'weekly_mean' THEN (SELECT mean_weight FROM weights WHERE k = 3) END, 6) AS weight
FROM forecasts GROUP BY model_id""",
    ),
    "one_hot_positions": sql(
        FEATURES,
        """, fitted AS (
  SELECT store_id, row_number() OVER (ORDER BY count(*) DESC, store_id)::INTEGER AS position
  FROM features WHERE snapshot_date < DATE '2001-06-07' GROUP BY store_id
)
SELECT DISTINCT store_id, coalesce(position, 0)::INTEGER AS position FROM features LEFT JOIN fitted USING (store_id)""",
    ),
    "policy_with_model": sql(
        POLICIES,
        """SELECT store_id, stock_code, policy_name, CASE WHEN policy_name = 'fixed_restock_300' THEN stockout_days END AS stockout_days,
  CASE WHEN policy_name = 'fixed_restock_300' THEN round(avg_stock_on_hand, 6) END AS avg_stock_on_hand, TRUE AS sound FROM policies""",
    ),
    "restock_with_model": sql(FEATURES, "SELECT count(*) AS count, TRUE AS sound FROM test"),
    "ranked_models": sql(
        FEATURES,
        """, scores AS (
  SELECT 'seasonal_naive_dow' AS model_id, avg(abs(units_demanded - seasonal_naive_pred)) AS mae,
         sqrt(avg((units_demanded - seasonal_naive_pred) ** 2)) AS rmse FROM test GROUP BY 1
  UNION ALL SELECT 'trailing_week_mean', avg(abs(units_demanded - rolling_mean_7)),
         sqrt(avg((units_demanded - rolling_mean_7) ** 2)) FROM test GROUP BY 1)
SELECT model_id, round(mae, 6) AS mae, round(rmse, 6) AS rmse, row_number() OVER (ORDER BY mae, model_id)::INTEGER AS rank,
  row_number() OVER (ORDER BY mae, model_id) = 1 AS is_leader FROM scores""",
    ),
    "restock_from_predictions": sql(
        FEATURES,
        """SELECT store_id, stock_code, snapshot_date, greatest(0, round_even(rolling_mean_7 * 7.0::DOUBLE
  + 1.65::DOUBLE * coalesce(rolling_std_7, 0) * sqrt(7.0::DOUBLE), 0))::BIGINT AS restock_level FROM test""",
    ),
    "opening_stock": sql(
        TYPE_PANEL,
        "SELECT store_id, stock_code, stock_on_hand AS opening_stock FROM snapshots WHERE snapshot_date = DATE '2001-06-06'",
    ),
    "policy_comparison": sql(
        POLICIES,
        "SELECT store_id, stock_code, policy_name, stockout_days, round(avg_stock_on_hand, 6) AS avg_stock_on_hand FROM policies",
    ),
    "policy_totals": sql(
        POLICIES,
        """SELECT policy_name, sum(stockout_days)::BIGINT AS total_stockout_days, round(avg(stockout_days), 6) AS avg_stockout_days,
  round(avg(avg_stock_on_hand), 6) AS avg_stock_on_hand FROM policies GROUP BY 1 ORDER BY policy_name <> 'fixed_restock_300'""",
    ),
    "policy_pivot": sql((*POLICIES, "wide"), _WIDE),
    "policy_change": sql(
        (*POLICIES, "wide"),
        """SELECT count(*) AS pairs, round(median(forecast_plus_safety_buffer - fixed_restock_300), 6) AS median_stock_change,
  count(*) FILTER (WHERE forecast_plus_safety_buffer < fixed_restock_300) AS pairs_lower,
  round(avg((forecast_plus_safety_buffer < fixed_restock_300)::INTEGER), 6) AS share_lower FROM wide""",
    ),
    "policy_largest_increases": sql(
        (*POLICIES, "wide"),
        _WIDE + " ORDER BY forecast_plus_safety_buffer - fixed_restock_300 DESC, store_id, stock_code LIMIT 5",
    ),
    "restock_distribution": sql(
        POLICIES,
        """SELECT count(*) AS count, round(avg(level), 6) AS mean, round(stddev_samp(level), 6) AS std, min(level) AS min,
  round(quantile_cont(level, 0.25), 6) AS p25, round(quantile_cont(level, 0.5), 6) AS p50,
  round(quantile_cont(level, 0.75), 6) AS p75, max(level) AS max,
  round(avg((level < 300)::INTEGER), 6) AS share_below_par FROM numbered""",
    ),
    "sales_summary": sql((*DAILY, "stores", "sales"), "SELECT * FROM sales"),
    "inventory_summary": sql(
        (*PANEL, "analysis", "stores", "products", "inventory"),
        "SELECT * REPLACE (round(days_of_supply, 6) AS days_of_supply, round(turnover_ratio, 6) AS turnover_ratio) FROM inventory",
    ),
    "store_performance": sql((*PROFIT, "performance"), "SELECT * FROM performance"),
    "headline_figures": sql(
        (*PROFIT, "sales", "performance"),
        """SELECT sum(revenue) AS total_revenue, sum(orders_count)::BIGINT AS total_orders,
  round(sum(revenue)::DOUBLE / sum(orders_count), 6) AS avg_order_value,
  (SELECT sum(profit_estimate) FROM performance) AS total_profit FROM sales""",
    ),
    "sales_measures_by_store": sql(
        (*DAILY, "stores", "sales"),
        """SELECT store_name, sum(revenue) AS total_revenue, sum(orders_count)::BIGINT AS total_orders,
  round(sum(revenue)::DOUBLE / sum(orders_count), 6) AS avg_order_value FROM sales GROUP BY 1""",
    ),
    "sales_page": sql((*DAILY, "stores", "sales"), _PAGE.format(slicer="TRUE")),
    "sliced_sales_page": sql(
        (*DAILY, "stores", "sales"), _PAGE.format(slicer="store_name IN ('London Dark Store', 'Dublin Dark Store')")
    ),
    "revenue_by_region": sql(
        (*DAILY, "stores", "sales"), "SELECT region, sum(revenue) AS total_revenue FROM sales GROUP BY 1"
    ),
    "revenue_by_day": sql(
        (*DAILY, "stores", "sales"), "SELECT metric_date, sum(revenue) AS total_revenue FROM sales GROUP BY 1"
    ),
    "inventory_measures_by_store": sql(
        (*PANEL, "analysis", "stores", "products", "inventory"),
        """SELECT store_name, round(avg(turnover_ratio), 6) AS avg_turnover_ratio,
  sum(stockout_days)::BIGINT AS total_stockout_days, round(avg(days_of_supply), 6) AS avg_days_of_supply
FROM inventory GROUP BY 1""",
    ),
    "profit_measures_by_store": sql(
        (*PROFIT, "performance"),
        "SELECT store_name, sum(profit_estimate) AS total_profit, round(avg(roi_pct), 6) AS avg_roi_pct FROM performance GROUP BY 1",
    ),
    "revenue_by_month": sql((*PROFIT, "performance"), "SELECT month, sum(revenue) AS total_revenue FROM performance GROUP BY 1"),
    "inventory_detail": sql(
        (*PANEL, "analysis", "stores", "products", "inventory"),
        """SELECT store_name, stock_code, description, round(days_of_supply, 6) AS days_of_supply,
  round(turnover_ratio, 6) AS turnover_ratio FROM inventory""",
    ),
    "sliced_revenue": sql(
        (*DAILY, "stores", "sales"),
        """SELECT store_name, sum(revenue) AS total_revenue FROM sales
WHERE store_id IN (SELECT store_id FROM stores WHERE name IN ('London Dark Store', 'Dublin Dark Store')) GROUP BY 1""",
    ),
    "dashboard_totals": sql(
        (*DAILY, "stores"),
        """SELECT sum(revenue) AS total_revenue, sum(orders_count)::BIGINT AS total_orders, (SELECT count(*) FROM stores) AS stores
FROM daily JOIN stores USING (store_id) WHERE name IN ('London Dark Store', 'Amsterdam Dark Store')""",
    ),
    "weekly_revenue": sql(
        (*DAILY, "stores"),
        """, ends AS (SELECT store_id, (date_trunc('week', metric_date) + INTERVAL 6 DAY)::DATE AS week_end, revenue FROM daily),
spans AS (SELECT store_id, unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY))::DATE AS week_end FROM ends GROUP BY 1)
SELECT name AS store_name, w.week_end, coalesce(sum(e.revenue), 0)::DECIMAL(28,2) AS revenue
FROM spans w JOIN stores USING (store_id) LEFT JOIN ends e ON e.store_id = w.store_id AND e.week_end = w.week_end GROUP BY 1, 2""",
    ),
    "inventory_health_by_store": sql(
        (*PANEL, "analysis", "stores"),
        """SELECT name AS store_name, round(avg(days_of_supply), 1) AS avg_days_of_supply,
  sum(stockout_days)::BIGINT AS total_stockout_days, round(avg(turnover_ratio), 1) AS avg_turnover_ratio
FROM analysis JOIN stores USING (store_id) GROUP BY 1""",
    ),
    "inventory_health_report": sql(
        (*PANEL, "analysis", "stores"),
        """SELECT name AS "Store", round(avg(days_of_supply), 1) AS "Avg days of supply",
  sum(stockout_days)::BIGINT AS "Total stockout events", round(avg(turnover_ratio), 1) AS "Avg turnover ratio (annualized)"
FROM analysis JOIN stores USING (store_id) GROUP BY 1""",
    ),
    "worst_stockouts": sql(
        (*PANEL, "analysis", "stores"),
        """SELECT name AS store_name, stock_code, stockout_days FROM analysis JOIN stores USING (store_id)
ORDER BY stockout_days DESC, store_id, stock_code LIMIT 10""",
    ),
    "profit_months": sql(PROFIT, "SELECT DISTINCT month FROM profit ORDER BY month DESC"),
    "profit_ranking": sql(
        PROFIT,
        """SELECT name AS store_name, month, revenue, cogs_estimate, opex_estimate, profit_estimate, roi_pct
FROM profit JOIN stores USING (store_id) WHERE month = (SELECT max(month) FROM profit)
ORDER BY profit_estimate DESC, store_name""",
    ),
    "profit_report": sql(
        PROFIT,
        """SELECT name AS "Store", revenue AS "Revenue", cogs_estimate AS "COGS (est.)", opex_estimate AS "Opex (est.)",
  profit_estimate AS "Profit (est.)", roi_pct AS "ROI %"
FROM profit JOIN stores USING (store_id) WHERE month = (SELECT max(month) FROM profit)""",
    ),
    "profitability_detail": sql(
        (*PROFIT, "performance"),
        "SELECT store_name, month, revenue, cogs_estimate, opex_estimate, profit_estimate, roi_pct FROM performance",
    ),
    "correlation_report": sql(
        (*DAILY, "correlation", "stores"),
        """SELECT a.name AS "Store A", b.name AS "Store B", round(r, 3) AS "Correlation" FROM correlation
JOIN stores a ON a.store_id = store_id_a JOIN stores b ON b.store_id = store_id_b""",
    ),
    "correlation_listing": sql(
        (*DAILY, "correlation", "stores"),
        """SELECT a.name AS store_a, b.name AS store_b, round(r, 3) AS correlation FROM correlation
JOIN stores a ON a.store_id = store_id_a JOIN stores b ON b.store_id = store_id_b""",
    ),
    "orphan_items": sql((*ROUTED, "headers"), f"SELECT {_ORPHANS} AS orphan_items"),
    "foreign_key_check": sql(
        (*ROUTED, "headers"),
        "SELECT invoice_no, count(*) AS row_count FROM routed_items WHERE invoice_no NOT IN (SELECT invoice_no FROM headers) GROUP BY 1",
    ),
    "primary_key_check": sql(
        LINES, "SELECT invoice_no, stock_code, count(*) AS row_count FROM lines GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "constraint_report": sql(
        (*ROUTED, "headers", "stores"),
        f"""SELECT 'order_items' AS table_name, 'primary_key' AS constraint_name,
  (SELECT count(*) FROM (SELECT 1 FROM routed_items GROUP BY invoice_no, stock_code HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'order_items', 'not_null', count(*) FROM routed_items
  WHERE invoice_no IS NULL OR stock_code IS NULL OR store_id IS NULL OR quantity IS NULL OR unit_price IS NULL
    OR revenue IS NULL OR order_date IS NULL
UNION ALL SELECT 'order_items', 'foreign_key_invoice_no', {_ORPHANS}
UNION ALL SELECT 'order_items', 'foreign_key_store_id', count(*) FROM routed_items WHERE store_id NOT IN (SELECT store_id FROM stores)""",
    ),
    "quality_report": sql(
        (*FEATURES, "orders_built", "daily"),
        """, baseline AS (SELECT avg(abs(units_demanded - seasonal_naive_pred)) AS mae,
  sqrt(avg((units_demanded - seasonal_naive_pred) ** 2)) AS rmse FROM test HAVING count(*) > 0),
gates(check_name, failures) AS (
  SELECT 'orphan_items', count(*) FROM items WHERE invoice_no NOT IN (SELECT invoice_no FROM orders_built)
  UNION ALL SELECT 'negative_revenue', count(*) FROM daily WHERE revenue < 0
  UNION ALL SELECT 'missing_models', 2 - 2 * (SELECT count(*) FROM baseline)
  UNION ALL SELECT 'invalid_metrics', count(*) FROM baseline WHERE mae IS NULL OR rmse IS NULL OR mae < 0 OR rmse < 0
)
SELECT check_name, failures, CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status FROM gates
UNION ALL SELECT 'model_versus_baseline', 0, 'model_beats_baseline'""",
    ),
    "upsert_merge": sql(
        DAILY,
        """SELECT store_id, metric_date, revenue, CASE WHEN metric_date >= DATE '1999-07-01' THEN orders_count ELSE 0 END AS orders_count,
  units_sold FROM daily""",
    ),
    "upsert_partial_columns": sql(
        DAILY,
        """SELECT store_id, metric_date, CASE WHEN metric_date < DATE '2000-01-01' THEN revenue END AS revenue,
  CASE WHEN metric_date < DATE '2000-01-01' THEN orders_count END AS orders_count,
  CASE WHEN metric_date >= DATE '1999-07-01' THEN units_sold * 2 ELSE units_sold END AS units_sold FROM daily""",
    ),
    "last_price": sql(
        LINES, "SELECT invoice_no, stock_code, arg_max(unit_price, line_no) AS unit_price FROM lines GROUP BY 1, 2"
    ),
    "status_rules": """SELECT count(*) AS total_rows, count(*) FILTER (WHERE ok) AS valid_rows, count(*) FILTER (WHERE NOT ok) AS invalid_rows,
  count(*) FILTER (WHERE l_orderkey IS NULL) AS l_orderkey_not_null,
  count(*) FILTER (WHERE l_discount NOT BETWEEN 0.0 AND 0.05) AS l_discount_in_range,
  count(*) FILTER (WHERE l_returnflag NOT IN ('N', 'R')) AS l_returnflag_allowed,
  count(*) FILTER (WHERE l_linestatus NOT IN ('F', 'O')) AS l_linestatus_allowed
FROM (SELECT *, l_orderkey IS NOT NULL AND l_discount BETWEEN 0.0 AND 0.05 AND l_returnflag IN ('N', 'R') AND l_linestatus IN ('F', 'O') AS ok
      FROM lineitem)""",
    "workbook_log": sql(
        ("log_part",),
        """SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, line_no FROM log""",
    ),
}
