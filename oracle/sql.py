"""SQL counterpart of each registered query."""

from __future__ import annotations

from oracle.ctes import (
    FEATURES, FLOAT_FEATURES, GRAIN_NAMES, IDS, METRICS, ORIGIN, POINT_COLUMNS, POINT_SQL,
    TARGET_LAGS, WEIGHTS, build,
)

ORACLES: dict[str, str] = {}
TLAGS = [f"target_lag_{k}" for k in TARGET_LAGS]
PRICED = ["target_sell_price", "price_ratio_to_origin", "price_ratio_to_mean_28"]
QS = ["yhat", "q05", "q50", "q95"]


def add(name: str, select: str, *needs: str, rounded=()) -> None:
    ORACLES[name] = build(select, *needs, rounded=rounded)


# Panel
add("demand_panel", "SELECT * FROM daily", "daily", rounded=["units", "sell_price"])
add("daily_sales", "SELECT * FROM sales", "sales", rounded=["units", "revenue"])
add("weekly_prices", "SELECT * FROM prices", "prices", rounded=["sell_price"])
add("wide_unpivot", "SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, units, day_num, series_id FROM dense", "dense", rounded=["units"])
add("csv_roundtrip_lineage", """
SELECT 'sales_train_evaluation' AS table_name, count(DISTINCT series_id) AS row_count, 6 + 2499 + 4 AS column_count,
       1 AS lineage_records, 'sales_train_evaluation.csv' AS source_file, 'roundtrip' AS run_id FROM dense
UNION ALL SELECT 'sell_prices', count(*), 4 + 4, 1, 'sell_prices.csv', 'roundtrip' FROM prices
UNION ALL SELECT 'calendar', count(*), 14 + 4, 1, 'calendar.csv', 'roundtrip' FROM cal""", "dense", "prices", "cal")
add("source_contract", """
SELECT 'sales_train_evaluation.csv' AS file, count(*) > 0 AS exists, CAST(6 + count(DISTINCT day_num) AS INT) AS columns,
       0 AS missing, count(*) > 0 AS valid FROM dense
UNION ALL SELECT 'sell_prices.csv', count(*) > 0, 4, 0, count(*) > 0 FROM prices
UNION ALL SELECT 'calendar.csv', count(*) > 0, 14, 0, count(*) > 0 FROM cal""", "dense", "prices", "cal")
add("wide_structure", """
SELECT count(DISTINCT series_id) AS series_rows, 6 AS identifier_columns, CAST(count(DISTINCT day_num) AS INT) AS daily_columns,
       'd_' || min(day_num) AS first_day, 'd_' || max(day_num) AS last_day FROM dense""", "dense")
add("stratified_series_sample", """
SELECT id, state_id, units, day_count FROM (
 SELECT *, row_number() OVER (PARTITION BY state_id ORDER BY md5(id || ':42'), id) AS place
 FROM (SELECT id, state_id, sum(units) AS units, count(*) AS day_count FROM dense GROUP BY ALL)) WHERE place <= 12""",
    "dense", rounded=["units"])
add("hash_fraction_sample", """
SELECT series_id, origin_day, horizon, target FROM train
WHERE ('0x' || substr(md5(series_id || ':' || origin_day || ':' || horizon || ':42'), 1, 8))::BIGINT / 4294967296.0 < 0.1""",
    "train", rounded=["target"])
add("fixed_size_sample", """
SELECT series_id, horizon, lag_1 FROM future
ORDER BY md5(series_id || ':' || horizon || ':42'), series_id, horizon LIMIT 2000""", "future", rounded=["lag_1"])
add("panel_quality", """
SELECT count(*) AS row_count, count(DISTINCT series_id) AS series, min(units) AS min_units, max(day_num) AS max_day,
       count(*) FILTER (date IS NULL) AS missing_dates,
       CAST(count(*) > count(DISTINCT (series_id, day_num)) AS INT) AS duplicate_keys,
       count(*) > 0 AND min(units) >= 0 AND count(*) FILTER (date IS NULL) = 0
         AND count(*) = count(DISTINCT (series_id, day_num)) AS valid
FROM daily""", "daily", rounded=["min_units"])
add("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
add("panel_gaps", """
SELECT series_id, count(*) AS row_count, max(day_num) - min(day_num) + 1 AS day_span FROM sales GROUP BY ALL
HAVING count(*) <> max(day_num) - min(day_num) + 1""", "sales")

# Profiles
add("demand_profile", """
SELECT count(*) AS row_count, count(DISTINCT series_id) AS series, sum(units) AS total_units, avg(units) AS mean_daily_units,
       stddev_pop(units) AS std_daily_units, avg(CAST(units = 0 AS DOUBLE)) AS zero_rate, min(date) AS first_date,
       max(date) AS last_date, quantile_disc(units, 0.5) AS p50, quantile_disc(units, 0.9) AS p90, quantile_disc(units, 0.99) AS p99
FROM daily""", "daily", rounded=["total_units", "mean_daily_units", "std_daily_units", "zero_rate", "p50", "p90", "p99"])
ACTIVITY = """
SELECT *, CASE WHEN zero_rate <= 0.5 THEN 'dense' WHEN zero_rate <= 0.8 THEN 'intermittent'
               WHEN zero_rate <= 0.95 THEN 'sparse' ELSE 'very_sparse' END AS demand_regime
FROM (SELECT series_id, state_id, cat_id, dept_id, avg(CAST(units = 0 AS DOUBLE)) AS zero_rate, sum(units) AS total_units,
             count(*) FILTER (units > 0) AS selling_days, avg(units) FILTER (units > 0) AS mean_nonzero_units
      FROM daily GROUP BY ALL)"""
add("series_activity", ACTIVITY, "daily", rounded=["zero_rate", "total_units", "mean_nonzero_units"])
add("intermittency_regimes", f"""
SELECT demand_regime, count(*) AS series, sum(total_units) AS units, avg(zero_rate) AS mean_zero_rate,
       quantile_disc(selling_days, 0.5) AS median_selling_days, count(*) / sum(count(*)) OVER () AS series_share,
       sum(total_units) / sum(sum(total_units)) OVER () AS demand_share
FROM ({ACTIVITY}) GROUP BY demand_regime""", "daily", rounded=["units", "mean_zero_rate", "series_share", "demand_share"])
add("retail_mix", """
SELECT state_id, cat_id, count(DISTINCT series_id) AS series, sum(units) AS units, avg(units) AS mean_daily_units,
       avg(CAST(units = 0 AS DOUBLE)) AS zero_rate, quantile_disc(units, 0.9) AS p90_units
FROM daily GROUP BY ALL""", "daily", rounded=["units", "mean_daily_units", "zero_rate", "p90_units"])
add("price_profile", """
SELECT cat_id, avg(CAST(price_missing AS DOUBLE)) AS missing_price_rate, min(sell_price) AS min_price, max(sell_price) AS max_price,
       quantile_disc(sell_price, 0.5) AS median_price, quantile_disc(sell_price, 0.9) AS p90_price
FROM daily GROUP BY ALL""", "daily", rounded=["missing_price_rate", "min_price", "max_price", "median_price", "p90_price"])
add("monthly_units", "SELECT CAST(date_trunc('month', date) AS DATE) AS month, sum(units) AS units FROM daily GROUP BY ALL", "daily", rounded=["units"])

# Features
add("origin_features", "SELECT series_id, day_num, " + ", ".join(FEATURES) + " FROM feat", "feat", rounded=FLOAT_FEATURES)
add("origin_snapshot", f"SELECT {IDS}, day_num AS origin_day, " + ", ".join(FEATURES) + " FROM feat JOIN origins ON day_num = o",
    "feat", "origins", rounded=FLOAT_FEATURES)
add("target_lags", "SELECT series_id, day_num, " + ", ".join(TLAGS) + " FROM lagged", "lagged", rounded=TLAGS)
add("future_target_lags_pivot", f"""
SELECT k.series_id, CAST({ORIGIN} + h AS INT) AS target_day,
{", ".join(f"max(units) FILTER (day_num = {ORIGIN} + h - {k}) AS target_lag_{k}" for k in TARGET_LAGS)}
FROM daily k CROSS JOIN steps WHERE day_num <= {ORIGIN} GROUP BY ALL""", "daily", "steps", rounded=TLAGS)
add("direct_training_features", "SELECT * FROM train", "train", rounded=["target", *PRICED, *TLAGS, *FLOAT_FEATURES])
add("forecast_features", "SELECT * FROM future", "future", rounded=[*PRICED, *TLAGS, *FLOAT_FEATURES])
add("feature_shape", """
SELECT count(*) AS row_count, count(DISTINCT series_id) AS series, count(DISTINCT origin_day) AS origins,
       count(DISTINCT horizon) AS horizons, min(origin_day) AS first_origin, max(origin_day) AS last_origin,
       min(target_date) AS first_target, max(target_date) AS last_target FROM train""", "train")
add("leakage_audit", """
SELECT count(*) FILTER (date_diff('day', origin_date, target_date) <> horizon) AS date_mismatches,
       count(*) FILTER (horizon < 1 OR horizon > 28) AS horizon_out_of_range,
       (SELECT count(*) FROM (SELECT DISTINCT series_id, origin_day, lag_1 FROM train) t
        JOIN daily d ON d.series_id = t.series_id AND d.day_num = t.origin_day
        WHERE lag_1 IS DISTINCT FROM units) AS lag_mismatches
FROM train""", "train", "daily")
REVIEWED = ("target", "lag_1", "lag_7", "lag_28", "lag_364", "rolling_mean_7", "rolling_mean_28", "nonzero_rate_28",
            "days_since_last_sale", "short_long_trend", "target_sell_price")
POINTS = {"q0": 0.0, "q50": 0.5, "q90": 0.9, "q99": 0.99, "q100": 1.0}
add("feature_null_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, avg(CAST({c} IS NULL AS DOUBLE)) AS null_rate, "
    + ", ".join(f"quantile_disc(CAST({c} AS DOUBLE), {p}) AS {n}" for n, p in POINTS.items()) + " FROM train" for c in REVIEWED),
    "train", rounded=["null_rate", *POINTS])
CATS = ("item_id", "dept_id", "cat_id", "store_id", "state_id", "target_event_type")
add("category_codes", "SELECT column_name, category, CAST(row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS DOUBLE) AS code FROM ("
    + " UNION ".join(f"SELECT '{c}' AS column_name, coalesce({c}, '__missing__') AS category FROM train" for c in CATS) + ")",
    "train", rounded=["code"])
ENCODED = ("item_id", "store_id", "state_id", "target_event_type")
add("encoded_categories", "WITH k AS (SELECT * FROM train WHERE origin_day < 2000 AND store_id <> 'WI_1'), "
    + ", ".join(f"d_{c} AS (SELECT coalesce({c}, '__missing__') AS v, CAST(row_number() OVER (ORDER BY coalesce({c}, '__missing__')) - 1 AS DOUBLE) AS code FROM k GROUP BY coalesce({c}, '__missing__'))" for c in ENCODED)
    + " SELECT " + ", ".join(f"coalesce(d_{c}.code, -1.0) AS {c}" for c in ENCODED) + ", count(*) AS row_count FROM train t "
    + " ".join(f"LEFT JOIN d_{c} ON d_{c}.v = coalesce(t.{c}, '__missing__')" for c in ENCODED) + " GROUP BY ALL",
    "train", rounded=ENCODED)

# Hierarchy
add("hierarchy_bridge", "SELECT * FROM bridge", "bridge")
add("hierarchy_rollup", "SELECT * FROM nodes", "nodes", rounded=["units", "revenue"])
add("node_scales", "SELECT level, level_name, node_id, fold_origin, scale, node_revenue FROM scales", "scales", rounded=["scale", "node_revenue"])
add("revenue_weights", "SELECT fold_origin, level, node_id, weight FROM scales", "scales", rounded=["weight"])
add("hierarchical_wrmsse", "SELECT * FROM details", "details", rounded=["rmsse", "weight", "weighted_rmsse"])
add("infinite_zero_scale", """
WITH sums AS (SELECT model_name, fold_origin, level, level_name, node_id, day_num, sum(target) AS t, sum(yhat) AS y
              FROM backtests JOIN bridge USING (series_id) GROUP BY ALL),
     errors AS (SELECT model_name, fold_origin, level, level_name, node_id, avg((t - y) * (t - y)) AS mse
                FROM sums GROUP BY ALL)
SELECT model_name, fold_origin, level, errors.level_name, node_id,
       CASE WHEN scale > 0 THEN sqrt(mse / scale) WHEN mse > 0 THEN 'inf'::DOUBLE ELSE 0.0 END AS rmsse
FROM errors LEFT JOIN scales USING (fold_origin, level, node_id)""", "backtests", "bridge", "scales", rounded=["rmsse"])
add("wrmsse_scores", "SELECT * FROM scores", "scores", rounded=["wrmsse", "bottom_rmsse"])
add("bottom_rmsse", "SELECT model_name, avg(bottom_rmsse) AS bottom_rmsse FROM scores GROUP BY ALL", "scores", rounded=["bottom_rmsse"])
add("series_rmsse", """
WITH firsts AS (SELECT series_id, min(day_num) AS first_day FROM daily WHERE units <> 0 AND day_num <= 2443 GROUP BY ALL),
     moves AS (SELECT series_id, units - lag(units) OVER (PARTITION BY series_id ORDER BY day_num) AS move
               FROM daily JOIN firsts USING (series_id) WHERE day_num BETWEEN first_day AND 2443),
     scale AS (SELECT series_id, avg(move * move) AS scale FROM moves GROUP BY ALL),
     errors AS (SELECT series_id, avg((target - yhat) * (target - yhat)) AS mse FROM backtests
                WHERE model_name = 'moving_average' AND fold_origin = 2443 GROUP BY ALL)
SELECT series_id, CASE WHEN scale > 0 THEN sqrt(mse / scale) WHEN mse > 0 THEN 'inf'::DOUBLE ELSE 0.0 END AS rmsse
FROM errors LEFT JOIN scale USING (series_id)""", "daily", "backtests", rounded=["rmsse"])

# Forecasts
for model in ("seasonal_naive", "moving_average"):
    add(model, f"SELECT series_id, origin_day, horizon, yhat FROM points WHERE model_name = '{model}'", "points", rounded=["yhat"])
add("residual_calibration", "SELECT * FROM offsets", "offsets", rounded=["o05", "o50", "o95"])
add("calibrated_intervals", "SELECT model_name, fold_origin, series_id, horizon, q05, q50, q95 FROM backtests", "backtests", rounded=["q05", "q50", "q95"])
add("baseline_backtest", "SELECT * FROM backtests", "backtests", rounded=["target", *QS, "unit_price"])
add("level_factor", """
SELECT model_name, fold_origin,
       CASE WHEN sum(yhat) > 0 THEN least(greatest(sum(target) / sum(yhat), 0.8), 1.25) ELSE 1.0 END AS level_factor
FROM known k WHERE origin_day = (SELECT max(origin_day) FROM known m WHERE m.fold_origin = k.fold_origin)
GROUP BY ALL""", "known", rounded=["level_factor"])
add("final_forecast", "SELECT * FROM forecasts", "forecasts", rounded=[*QS, "unit_price"])
ROLLED = """
SELECT level, level_name, node_id, model_name, origin_date, target_date, horizon, sum(yhat) AS yhat, sum(q05) AS q05,
       sum(q50) AS q50, sum(q95) AS q95 FROM forecasts JOIN bridge USING (series_id) GROUP BY ALL"""
add("final_forecast_hierarchy", ROLLED, "forecasts", "bridge", rounded=QS)
add("bridge_forecast_hierarchy", ROLLED, "forecasts", "bridge", rounded=QS)

# Accuracy
add("point_metrics_by_fold", "SELECT * FROM by_fold", "by_fold", rounded=METRICS)
add("backtest_summary", "SELECT * FROM averaged", "averaged", rounded=METRICS)
add("wape_by_granularity", "SELECT * FROM granular", "granular", rounded=POINT_COLUMNS)
PIVOT = "SELECT model_name, " + ", ".join(f"max(wape) FILTER (granularity = '{g}') AS {g}" for g in GRAIN_NAMES) + " FROM granular GROUP BY ALL"
add("wape_pivot", PIVOT, "granular", rounded=GRAIN_NAMES)
SUMS = "sum(target) AS demand, sum(abs(yhat - target)) AS abs_error, sum(yhat - target) AS signed_error"
RATES = "abs_error / greatest(demand, 1e-12) AS wape, signed_error / greatest(demand, 1e-12) AS bias"
SUMMED = ["demand", "abs_error", "signed_error", "wape", "bias"]
add("regime_errors", f"""
WITH z AS (SELECT series_id, avg(CAST(target = 0 AS DOUBLE)) AS r FROM backtests WHERE model_name = 'moving_average' GROUP BY ALL)
SELECT *, {RATES} FROM (SELECT model_name, CASE WHEN r <= 0.5 THEN 'dense' WHEN r <= 0.8 THEN 'intermittent' WHEN r <= 0.95 THEN 'sparse'
       ELSE 'very_sparse' END AS demand_regime, count(*) AS row_count, count(DISTINCT series_id) AS series, {SUMS}
 FROM backtests JOIN z USING (series_id) GROUP BY ALL)""", "backtests", rounded=SUMMED)
add("horizon_errors", """
SELECT model_name, horizon, sum(target) AS demand, sum(abs(yhat - target)) AS abs_error, avg(abs(yhat - target)) AS mae,
       sum(yhat - target) AS bias_units, sum(abs(yhat - target)) / greatest(sum(target), 1e-12) AS wape,
       sum(yhat - target) / greatest(sum(target), 1e-12) AS bias FROM backtests GROUP BY ALL""",
    "backtests", rounded=["demand", "abs_error", "mae", "bias_units", "wape", "bias"])
add("segment_errors", f"SELECT *, {RATES} FROM (" + " UNION ALL ".join(
    f"SELECT model_name, '{c}' AS dimension, {c} AS segment, count(DISTINCT series_id) AS series, {SUMS} FROM backtests GROUP BY ALL"
    for c in ("state_id", "cat_id", "dept_id")) + ")", "backtests", rounded=SUMMED)
add("review_flag", f"""
SELECT model_name, sku_store_day AS sku_store_day_wape, store_day AS store_day_wape, CAST(0.5 AS DOUBLE) AS review_threshold,
       CASE WHEN sku_store_day > 0.5 THEN 'needs improvement' ELSE 'passes review' END AS item_status,
       CASE WHEN store_day > 0.5 THEN 'needs improvement' ELSE 'passes review' END AS store_planning_status FROM ({PIVOT})""",
    "granular", rounded=["sku_store_day_wape", "store_day_wape", "review_threshold"])
add("zero_demand_share", "SELECT model_name, avg(CAST(target = 0 AS DOUBLE)) AS zero_share FROM backtests GROUP BY ALL", "backtests", rounded=["zero_share"])
add("fold_degradation", "SELECT * FROM degradation", "degradation", rounded=["max_fold_degradation"])
SUMMARY = ["mean_wrmsse", *POINT_COLUMNS, "coverage", "mean_interval_width", "mean_pinball_loss", "bottom_rmsse", "max_fold_degradation"]
add("model_summary", "SELECT * FROM summary", "summary", rounded=SUMMARY)
add("select_winner", """
SELECT model_name, mean_wrmsse, eligible FROM judged ORDER BY eligible DESC, mean_wrmsse, model_name LIMIT 1""", "judged", rounded=["mean_wrmsse"])
add("promotion_gate", """
SELECT model_name, reasons = '' AS promoted, reasons FROM (
 SELECT j.model_name, concat_ws(',', CASE WHEN abs(j.bias) > 0.05 THEN 'bias_guardrail' END,
   CASE WHEN NOT j.coverage BETWEEN 0.85 AND 0.95 THEN 'coverage_guardrail' END,
   CASE WHEN j.max_fold_degradation > 0.05 THEN 'fold_degradation_guardrail' END,
   CASE WHEN j.mean_wrmsse > i.mean_wrmsse * (1 - 0.01::DOUBLE) THEN 'insufficient_wrmsse_improvement' END) AS reasons
 FROM judged j, (SELECT mean_wrmsse FROM summary WHERE model_name = 'seasonal_naive') i)""", "judged", "summary")
add("accuracy_table", f"""
SELECT s.model_name, s.mean_wrmsse, a.* EXCLUDE (model_name), b.bottom_rmsse, p.* EXCLUDE (model_name)
FROM summary s JOIN averaged a ON a.model_name = s.model_name
JOIN (SELECT model_name, avg(bottom_rmsse) AS bottom_rmsse FROM scores GROUP BY ALL) b ON b.model_name = s.model_name
JOIN ({PIVOT}) p ON p.model_name = s.model_name""", "summary", "averaged", "scores", "granular",
    rounded=["mean_wrmsse", *METRICS, "bottom_rmsse", *GRAIN_NAMES])
add("model_labels", """
SELECT model_name, count(*) AS row_count, CASE model_name WHEN 'seasonal_naive' THEN 'Seasonal Naive'
       WHEN 'moving_average' THEN 'Moving Average' END AS label FROM backtests GROUP BY ALL""", "backtests")
add("demand_outlook", "SELECT store_id, target_date, cat_id, sum(q50) AS q50 FROM forecasts GROUP BY ALL", "forecasts", rounded=["q50"])
add("forecast_view", """
SELECT series_id, target_date, yhat, q05, q50, q95 FROM forecasts WHERE store_id = 'CA_1' AND cat_id = 'FOODS'""", "forecasts", rounded=QS)
add("top_series", """
SELECT series_id, sum(q50) AS median_units FROM forecasts GROUP BY ALL ORDER BY round(sum(q50), 9) DESC, series_id LIMIT 1""",
    "forecasts", rounded=["median_units"])

# Post-processing
ERR = "sum(abs(CASE WHEN yhat < t THEN 0.0 ELSE yhat END * s - target)) / greatest(sum(abs(target)), 1e-12) AS wape"
BIAS = "sum(CASE WHEN yhat < t THEN 0.0 ELSE yhat END * s - target) / greatest(sum(abs(target)), 1e-12) AS bias"
GRID = """(SELECT i * 0.1::DOUBLE AS t, 0.6::DOUBLE + j * 0.025::DOUBLE AS s FROM range(0, 16) a(i), range(0, 25) b(j))"""
WIDE = "(SELECT '-inf'::DOUBLE AS t, 0.5::DOUBLE + j * 0.025::DOUBLE AS s FROM range(0, 61) b(j))"
FIRST = "row_number() OVER (PARTITION BY {keys} ORDER BY round(wape, 10), {order}) = 1"
add("threshold_scale_grid", f"""
SELECT model_name, fold_origin, t AS threshold, s AS scale, wape, bias FROM (
 SELECT model_name, fold_origin, t, s, {ERR}, {BIAS} FROM backtests, {GRID} GROUP BY ALL)
QUALIFY {FIRST.format(keys='model_name, fold_origin', order='t, s')}""", "backtests", rounded=["threshold", "scale", "wape", "bias"])
add("unbiased_scale_grid", f"""
SELECT model_name, fold_origin, s AS scale, wape, bias FROM (
 SELECT model_name, fold_origin, t, s, {ERR}, {BIAS} FROM backtests, {WIDE} GROUP BY ALL) WHERE abs(round(bias, 10)) <= 0.05
QUALIFY {FIRST.format(keys='model_name, fold_origin', order='s')}""", "backtests", rounded=["scale", "wape", "bias"])
AT = "(SELECT * FROM points WHERE model_name = 'moving_average' AND origin_day = {0})"
add("threshold_scale_applied", f"""
WITH best AS (SELECT t, s FROM (SELECT t, s, {ERR} FROM {AT.format(2415)}, {GRID} GROUP BY ALL) ORDER BY round(wape, 10), t, s LIMIT 1),
     applied AS (SELECT target, CASE WHEN yhat < t THEN 0.0 ELSE yhat END * s AS yhat FROM {AT.format(2443)}, best)
SELECT {POINT_SQL} FROM applied""", "points", rounded=POINT_COLUMNS)
GROUPS = {"series_calibration": ("series_id", 28), "series_horizon_cal": ("series_id, horizon", 10),
          "store_item_cal": ("store_id, item_id", 28), "store_dept_cal": ("store_id, dept_id", 100), "dept_horizon_cal": ("dept_id, horizon", 100)}
SCALE = "least(greatest((sum(target) + {p}::DOUBLE) / (sum(yhat) + {p}::DOUBLE), 0.5), 2.0) AS g"
add("group_scale", " UNION ALL ".join(
    f"SELECT {POINT_SQL}, '{n}' AS variant FROM (SELECT target, e.yhat * coalesce(g, 1.0) AS yhat FROM {AT.format(2443)} e LEFT JOIN "
    f"(SELECT {c}, {SCALE.format(p=p)} FROM {AT.format(2415)} GROUP BY {c}) k USING ({c}))" for n, (c, p) in GROUPS.items()),
    "points", rounded=POINT_COLUMNS)
add("group_scale_factors", f"SELECT store_id, dept_id, g AS group_scale FROM (SELECT store_id, dept_id, {SCALE.format(p=100)} FROM {AT.format(2415)} GROUP BY ALL)",
    "points", rounded=["group_scale"])
SEASONAL = "list_avg(list_filter([target_lag_28, target_lag_35, target_lag_42, target_lag_49, target_lag_56], lambda x: x IS NOT NULL))"
add("seasonal_mean", f"SELECT series_id, origin_day, horizon, {SEASONAL} AS yhat FROM train", "train", rounded=["yhat"])
add("seasonal_mean_blend", f"""
WITH v AS (SELECT target, w AS weight, w * greatest(coalesce(rolling_mean_28, 0.0), 0.0) + (1.0::DOUBLE - w) * {SEASONAL} AS yhat
           FROM train, (SELECT i * 0.1::DOUBLE AS w FROM range(0, 11) a(i)) WHERE origin_day = 2415)
SELECT weight, s AS scale, wape, bias FROM (SELECT weight, t, s, {ERR}, {BIAS} FROM v, {WIDE} GROUP BY ALL)
WHERE abs(round(bias, 10)) <= 0.05 ORDER BY round(wape, 10), weight, s LIMIT 1""", "train", rounded=["weight", "scale", "wape", "bias"])

# Inventory
add("residual_blocks", """
SELECT model_name, fold_origin, series_id, CAST(unnest(range(0, 28)) AS INT) AS step, unnest(block) AS residual FROM blocks""", "blocks", rounded=["residual"])
add("order_up_to_bootstrap", "SELECT * FROM levels", "levels", rounded=["level"])
ADVICE = ["service_level", "on_hand", "reorder_point", "order_up_to", "suggested_order_quantity"]
add("recommendations", "SELECT * FROM advice", "advice", rounded=ADVICE)
add("largest_order", "SELECT series_id, suggested_order_quantity FROM advice ORDER BY suggested_order_quantity DESC, series_id LIMIT 1",
    "advice", rounded=["suggested_order_quantity"])

# Attribution
IMPORTANCE = ["mean_abs_shap", "mean_shap", "positive_share", "negative_share", "importance_share"]
add("attribution_table", "SELECT * FROM attr", "attr",
    rounded=[*[f"shap_{c}" for c in WEIGHTS], *[f"feature_{c}" for c in WEIGHTS], "base_value", "model_output"])
add("attribution_global", "SELECT * FROM attr_global", "attr_global", rounded=IMPORTANCE)
add("attribution_family", """
SELECT feature_group, sum(mean_abs_shap) AS mean_abs_shap, sum(importance_share) AS importance_share FROM attr_global GROUP BY ALL""",
    "attr_global", rounded=["mean_abs_shap", "importance_share"])
add("attribution_horizon", "SELECT * FROM attr_horizon", "attr_horizon", rounded=["mean_abs_shap"])
add("attribution_segment", r"""
WITH p AS (SELECT series_id, horizon, feature, abs(value) AS v, regexp_extract(series_id, '^([^_]+)_.+_([A-Z]{2}_\d+)$', 1) AS cat,
                  regexp_extract(series_id, '^([^_]+)_.+_([A-Z]{2}_\d+)$', 2) AS store FROM attr_long),
     s AS (SELECT *, 'state' AS segment_type, split_part(store, '_', 1) AS segment FROM p
           UNION ALL SELECT *, 'store', store FROM p UNION ALL SELECT *, 'category', cat FROM p),
     f AS (SELECT segment_type, segment, feature, count(*) AS n, count(DISTINCT series_id) AS k, avg(v) AS m FROM s GROUP BY ALL)
SELECT segment_type, segment, any_value(n) AS row_count, any_value(k) AS series_count, sum(m) AS mean_total_abs_shap,
       first(feature ORDER BY m DESC, feature) AS top_feature, max(m) AS top_feature_mean_abs_shap
FROM f GROUP BY segment_type, segment""", "attr_long", rounded=["mean_total_abs_shap", "top_feature_mean_abs_shap"])
add("attribution_local", """
WITH top AS (SELECT * FROM attr_total ORDER BY total DESC, series_id, horizon LIMIT 10),
     r AS (SELECT *, row_number() OVER (PARTITION BY series_id, horizon ORDER BY abs(value) DESC, feature) AS k
           FROM attr_long JOIN top USING (series_id, horizon))
SELECT series_id, horizon, any_value(total) AS total_abs_shap, max(feature) FILTER (k = 1) AS top_driver,
       max(value) FILTER (k = 1) AS top_driver_shap,
       CASE WHEN max(value) FILTER (k = 1) > 0 THEN 'raises forecast' ELSE 'lowers forecast' END AS direction,
       string_agg(feature || ' (' || printf('%+.3f', value) || ')', '; ' ORDER BY k) FILTER (k <= 3) AS top_three_drivers
FROM r GROUP BY series_id, horizon""", "attr_total", "attr_long", rounded=["total_abs_shap", "top_driver_shap"])
add("attribution_summary", """
SELECT (SELECT count(*) FROM attr) AS sample_rows, (SELECT count(DISTINCT series_id) FROM attr) AS series_count,
       (SELECT count(DISTINCT horizon) FROM attr) AS horizon_count, count(*) AS feature_count,
       max(feature) FILTER (rank = 1) AS top_feature, max(mean_abs_shap) FILTER (rank = 1) AS top_feature_mean_abs_shap,
       max(importance_share) FILTER (rank = 1) AS top_feature_share, sum(importance_share) FILTER (rank <= 5) AS top_five_share,
       coalesce(sum(importance_share) FILTER (feature_group = 'Demand history'), 0.0) AS demand_history_share,
       coalesce(sum(importance_share) FILTER (feature_group = 'Calendar and horizon'), 0.0) AS calendar_horizon_share,
       coalesce(sum(importance_share) FILTER (feature_group = 'Identifiers'), 0.0) AS identifier_share,
       coalesce(sum(importance_share) FILTER (feature_group = 'Price'), 0.0) AS price_share,
       (SELECT count(*) FROM attr_horizon h WHERE h.rank = 1 AND h.feature = (SELECT feature FROM attr_global WHERE rank = 1))
         AS top_feature_horizon_count
FROM attr_global""", "attr", "attr_global", "attr_horizon",
    rounded=["top_feature_mean_abs_shap", "top_feature_share", "top_five_share", "demand_history_share",
             "calendar_horizon_share", "identifier_share", "price_share"])


# Contracts
def rules(source: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS checked, count(*) FILTER (NOT coalesce({ok}, false)) AS failures FROM {source}"
        for name, ok in checks.items())


add("forecast_contract", rules("forecasts", {
    "horizon_positive": "horizon > 0", **{f"{c}_not_negative": f"{c} >= 0" for c in QS},
    "quantiles_ordered": "q05 <= q50 AND q50 <= q95"}), "forecasts")
add("recommendation_contract", rules("advice", {
    "lead_time_positive": "lead_time_days > 0", "review_period_positive": "review_period_days > 0",
    "service_level_inside": "service_level > 0 AND service_level < 1",
    **{f"{c}_not_negative": f"{c} >= 0" for c in ("on_hand", "reorder_point", "order_up_to", "suggested_order_quantity")}}), "advice")
add("future_blind_audit", "SELECT count(*) AS row_count, 0 AS differences FROM train WHERE origin_day = 2443", "train")

# Learned models: the rows forecast, and properties that hold whatever the fitted digits are.
for _kind in ("tweedie", "gbt", "tweedie_trees"):
    add(f"{_kind}_forecast", f"""
SELECT '{_kind}' AS model_name, series_id, origin_day, horizon, target, true AS ordered, true AS valid
FROM train WHERE origin_day = 2443""", "train", rounded=["target"])
add("temporal_grid_search", """
SELECT 'tweedie' AS kind, CAST(row_number() OVER (ORDER BY r, v) - 1 AS INT) AS candidate, CAST(r AS VARCHAR) AS reg_param,
       CAST(v AS VARCHAR) AS variance_power, true AS scored, true AS chosen_is_lowest
FROM (VALUES (0.001::DOUBLE), (0.01), (0.1)) a(r), (VALUES (1.1::DOUBLE), (1.3), (1.5)) b(v)""")
add("hurdle_forecast", "SELECT series_id, horizon, target, true AS probable, true AS product_holds FROM train WHERE origin_day = 2443",
    "train", rounded=["target"])
add("objective_comparison", """
SELECT unnest(['tweedie_1.1', 'tweedie_1.2', 'tweedie_1.5', 'l1', 'quantile_0.5', 'poisson', 'huber']) AS variant, true AS scaled, true AS scored,
       true AS consistent""")
add("learned_final_forecast", f"SELECT {IDS}, origin_day, horizon, true AS ordered, true AS valid, true AS factor_bounded FROM future", "future")
add("trees_against_naive", "SELECT 'tweedie_trees' AS model_name, unnest(['seasonal_naive', 'tweedie']) AS other, true AS better")
add("boosting_loss_falls", "SELECT round::INT AS round, true AS falls FROM range(11) r(round)")
add("tree_attribution_sums", "SELECT series_id, horizon, true AS adds_up FROM future", "future")
add("halving_structure", """
SELECT * FROM (VALUES (0, 6, 2, true), (1, 2, 1, true), (2, 1, 1, true)) v(rung, candidates, kept, lowest_kept)""")
add("glm_attribution", "SELECT series_id, horizon, true AS adds_up FROM future", "future")

add("state_snap_days", """
SELECT state_id, CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX WHEN 'WI' THEN snap_WI ELSE 0 END AS own_snap,
       count(*) AS row_count, sum(units) AS units FROM daily GROUP BY ALL""", "daily", rounded=["units"])
add("lake_round_trip", """
SELECT state_id, year, count(*) AS row_count, sum(units) AS units, sum(count(*)) OVER () AS reported_rows, 25 AS columns
FROM daily GROUP BY state_id, year""", "daily", rounded=["units"])
add("price_backfill", "SELECT model_name, series_id, fold_origin, horizon, unit_price FROM backtests", "backtests", rounded=["unit_price"])
add("attribution_top", "SELECT * FROM attr_global WHERE rank <= 5", "attr_global", rounded=IMPORTANCE)

# Files of customer lines: blocks are cut from their text, which is ASCII.
CUSTOMER_FILES = """
SELECT c_custkey // 500 AS slice,
       string_agg(concat_ws('|', c_custkey, c_name, c_nationkey, c_mktsegment) || chr(10), '' ORDER BY c_custkey,
                  concat_ws('|', c_custkey, c_name, c_nationkey, c_mktsegment)) AS content
FROM customer GROUP BY c_custkey // 500"""
add("file_block_digests", f"""
WITH files AS ({CUSTOMER_FILES}),
blocks AS (SELECT slice, content, unnest(range(0, greatest(length(content), 1), 4096)) AS start FROM files),
hashed AS (SELECT slice, length(content) AS size_bytes, start, sha256(substring(content, start + 1, 4096)) AS digest FROM blocks)
SELECT slice, size_bytes, CASE count(*) WHEN 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY start)) END AS sha256
FROM hashed GROUP BY slice, size_bytes""")
LEVEL = "CASE count(*) WHEN 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY prefix)) END AS digest"
add("source_set_digest", f"""
WITH files AS ({CUSTOMER_FILES}),
leaves AS (
    SELECT times, sha256(content) AS prefix, count(*) * times AS parts, sum(length(content)) * times AS size_bytes
    FROM files, (VALUES (1), (2)) t(times) GROUP BY times, sha256(content)),
marked AS (SELECT times, prefix, parts, size_bytes, CASE parts WHEN 1 THEN prefix ELSE sha256(prefix || ':' || parts) END AS digest FROM leaves),
six AS (SELECT times, left(prefix, 6) AS shorter, sum(parts) AS parts, sum(size_bytes) AS size_bytes, {LEVEL}
    FROM marked GROUP BY times, left(prefix, 6)),
three AS (SELECT times, left(prefix, 3) AS shorter, sum(parts) AS parts, sum(size_bytes) AS size_bytes, {LEVEL}
    FROM (SELECT * RENAME (shorter AS prefix) FROM six) GROUP BY times, left(prefix, 3))
SELECT times::INT AS times, sum(size_bytes)::BIGINT AS size_bytes, sum(parts)::BIGINT AS parts, {LEVEL.replace(' AS digest', ' AS sha256')}
FROM (SELECT * RENAME (shorter AS prefix) FROM three) GROUP BY times""")
