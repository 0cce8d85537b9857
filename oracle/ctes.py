"""Shared common table expressions of the SQL counterparts."""

from __future__ import annotations

from collections.abc import Sequence

LAGS = (1, 2, 3, 4, 5, 6, 7, 14, 28, 56, 364)
TARGET_LAGS = (28, 35, 42, 49, 56, 364)
ROLLING = (7, 28, 56)
FOLDS = (2387, 2415, 2443)
ORIGIN = 2471
IDS = "series_id, item_id, dept_id, cat_id, store_id, state_id"

LEVELS = (
    (), ("state_id",), ("store_id",), ("cat_id",), ("dept_id",), ("state_id", "cat_id"), ("state_id", "dept_id"),
    ("store_id", "cat_id"), ("store_id", "dept_id"), ("item_id",), ("state_id", "item_id"), ("store_id", "item_id"),
)

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def build(select: str, *needs: str, rounded: Sequence[str] = ()) -> str:
    """Full statement: the needed expressions in dependency order, then the select."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in CTES[name][1]:
            visit(need)
        ordered.append(name)

    for need in needs:
        visit(need)
    head = ", ".join(f"{name} AS MATERIALIZED ({CTES[name][0]})" for name in ordered)
    if rounded:
        fixed = ", ".join(f"round({c} + 1.37e-9, 6) + 0.0 AS {c}" for c in rounded)
        select = f"SELECT * REPLACE ({fixed}) FROM ({select})"
    return f"WITH RECURSIVE {head} {select}" if head else select


FEATURES = [
    *[f"lag_{k}" for k in LAGS],
    *[f"{s}_{w}" for w in ROLLING for s in ("rolling_mean", "rolling_std", "rolling_max", "nonzero_rate")],
    "days_since_last_sale", "days_since_first_sale", "short_long_trend", "origin_sell_price", "origin_price_mean_28",
]
FLOAT_FEATURES = [c for c in FEATURES if not c.startswith("days_since")]

cte("items", r"""
SELECT p_partkey, dept_id || '_' || lpad(CAST(b AS VARCHAR), 3, '0') AS item_id, dept_id,
       split_part(dept_id, '_', 1) AS cat_id
FROM (SELECT p_partkey, b,
             ['FOODS_1','FOODS_2','HOUSEHOLD_1','HOUSEHOLD_2','HOBBIES_1'][(b - 1) // 5 + 1] AS dept_id
      FROM (SELECT p_partkey, CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INT) AS b FROM part))
""")
cte("stores", """
SELECT s_suppkey, store_id, split_part(store_id, '_', 1) AS state_id
FROM (SELECT s_suppkey, ['CA_1','CA_2','TX_1','TX_2','WI_1'][n_regionkey + 1] AS store_id
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)
""")
cte("sales", """
SELECT item_id || '_' || store_id AS series_id, item_id, dept_id, cat_id, store_id, state_id,
       CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INT) AS day_num,
       sum(l_quantity) AS units, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN items ON l_partkey = p_partkey JOIN stores ON l_suppkey = s_suppkey
GROUP BY ALL
""", "items", "stores")
cte("cal", """
SELECT 'd_' || n AS d, CAST(n AS INT) AS day_num, date, CAST((n - 1) // 7 + 1 AS INT) AS wm_yr_wk,
       dayname(date) AS weekday, CAST(n % 7 + 1 AS INT) AS wday, CAST(month(date) AS INT) AS month,
       CAST(year(date) AS INT) AS year,
       CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'NewYear' WHEN '07-04' THEN 'IndependenceDay'
            WHEN '12-25' THEN 'Christmas' WHEN '02-14' THEN 'ValentinesDay' WHEN '10-31' THEN 'Halloween' END
            AS event_name_1,
       CASE WHEN strftime(date, '%m-%d') IN ('01-01','07-04','12-25') THEN 'National'
            WHEN strftime(date, '%m-%d') IN ('02-14','10-31') THEN 'Cultural' END AS event_type_1,
       CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
       CAST(day(date) <= 10 AS INT) AS snap_CA,
       CAST(day(date) % 2 = 1 AND day(date) <= 15 AS INT) AS snap_TX,
       CAST(day(date) BETWEEN 5 AND 15 AS INT) AS snap_WI
FROM (SELECT n, DATE '1995-01-01' + CAST(n AS INT) AS date FROM generate_series(1, 2499) g(n))
""")
cte("paid", """
SELECT store_id, item_id, (day_num - 1) // 7 + 1 AS seen,
       CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) / sum(units) AS sell_price
FROM sales GROUP BY ALL
""", "sales")
cte("prices", """
SELECT p.store_id, p.item_id, CAST(w AS INT) AS wm_yr_wk, arg_max(sell_price, seen) AS sell_price
FROM paid p JOIN generate_series(1, 357) g(w) ON w >= seen + 5
GROUP BY ALL
""", "paid")
cte("dense", f"""
SELECT k.*, k.series_id || '_evaluation' AS id, 'd_' || n AS d, CAST(n AS INT) AS day_num,
       coalesce(s.units, 0.0) AS units
FROM (SELECT DISTINCT {IDS} FROM sales) k CROSS JOIN generate_series(1, 2499) g(n)
LEFT JOIN sales s ON s.series_id = k.series_id AND s.day_num = n
""", "sales")
cte("daily", """
SELECT dense.*, cal.* EXCLUDE (d, day_num), sell_price, sell_price IS NULL AS price_missing
FROM dense JOIN cal USING (d, day_num) LEFT JOIN prices USING (store_id, item_id, wm_yr_wk)
""", "dense", "cal", "prices")


def _feature_sql() -> str:
    w = "PARTITION BY series_id ORDER BY day_num"
    parts = [f"lag(units, {k - 1}) OVER ({w}) AS lag_{k}" if k > 1 else "units AS lag_1" for k in LAGS]
    for n in ROLLING:
        frame = f"OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        parts += [
            f"avg(units) {frame} AS rolling_mean_{n}",
            f"stddev_pop(units) {frame} AS rolling_std_{n}",
            f"max(units) {frame} AS rolling_max_{n}",
            f"avg(CAST(units > 0 AS DOUBLE)) {frame} AS nonzero_rate_{n}",
        ]
    run = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    parts += [
        f"day_num - max(CASE WHEN units > 0 THEN day_num END) {run} AS days_since_last_sale",
        f"day_num - min(CASE WHEN units > 0 THEN day_num END) {run} AS days_since_first_sale",
        "sell_price AS origin_sell_price",
        f"avg(sell_price) OVER ({w} ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS origin_price_mean_28",
    ]
    inner = f"SELECT {IDS}, day_num, date, " + ", ".join(parts) + f" FROM daily WHERE day_num <= {ORIGIN}"
    return f"SELECT *, rolling_mean_7 / greatest(rolling_mean_28, 0.1) AS short_long_trend FROM ({inner})"


cte("feat", _feature_sql(), "daily")
cte("lagged", "SELECT series_id, day_num, " + ", ".join(
    f"lag(units, {k}) OVER (PARTITION BY series_id ORDER BY day_num) AS target_lag_{k}" for k in TARGET_LAGS
) + " FROM daily", "daily")
cte("origins", "SELECT CAST(o AS INT) AS o FROM range(1713, 2444, 28) r(o) UNION "
    f"SELECT CAST(unnest([{', '.join(map(str, FOLDS))}]) AS INT)")
cte("steps", "SELECT CAST(h AS INT) AS h FROM generate_series(1, 28) g(h)")


def _price_features(source: str) -> str:
    return f"""
SELECT * EXCLUDE (raw_price, origin_sell_price, origin_price_mean_28),
       coalesce(raw_price, 0.0) AS target_sell_price, coalesce(origin_sell_price, 0.0) AS origin_sell_price,
       coalesce(origin_price_mean_28, 0.0) AS origin_price_mean_28,
       CAST(raw_price IS NULL AS INT) AS price_missing,
       CASE WHEN origin_sell_price > 0 THEN 0 ELSE 1 END AS origin_price_missing,
       CASE WHEN origin_sell_price > 0 THEN raw_price / origin_sell_price ELSE 0.0 END AS price_ratio_to_origin,
       CASE WHEN origin_price_mean_28 > 0 THEN raw_price / origin_price_mean_28 ELSE 0.0 END AS price_ratio_to_mean_28
FROM ({source})"""


_AHEAD = ("c.date AS target_date, c.wday AS target_wday, c.month AS target_month, c.event_type_1 AS target_event_type, "
          "c.snap_CA AS target_snap_CA, c.snap_TX AS target_snap_TX, c.snap_WI AS target_snap_WI")
_FEAT = ", ".join(f"f.{c}" for c in FEATURES)
_TLAG = ", ".join(f"l.target_lag_{k}" for k in TARGET_LAGS)
cte("train", _price_features(f"""
SELECT f.series_id, f.item_id, f.dept_id, f.cat_id, f.store_id, f.state_id, f.day_num AS origin_day,
       f.date AS origin_date, h AS horizon, t.units AS target, t.sell_price AS raw_price, {_AHEAD}, {_TLAG}, {_FEAT}
FROM feat f JOIN origins ON f.day_num = o CROSS JOIN steps
JOIN daily t ON t.series_id = f.series_id AND t.day_num = f.day_num + h
JOIN cal c ON c.day_num = t.day_num
JOIN lagged l ON l.series_id = t.series_id AND l.day_num = t.day_num"""), "feat", "origins", "steps", "lagged", "cal")
cte("future", _price_features(f"""
SELECT f.series_id, f.item_id, f.dept_id, f.cat_id, f.store_id, f.state_id, f.day_num AS origin_day,
       f.date AS origin_date, h AS horizon, p.sell_price AS raw_price, {_AHEAD}, {_TLAG}, {_FEAT}
FROM feat f CROSS JOIN steps JOIN cal c ON c.day_num = f.day_num + h
LEFT JOIN prices p ON p.store_id = f.store_id AND p.item_id = f.item_id AND p.wm_yr_wk = c.wm_yr_wk
LEFT JOIN lagged l ON l.series_id = f.series_id AND l.day_num = c.day_num
WHERE f.day_num = {ORIGIN}"""), "feat", "steps", "lagged", "cal", "prices")

_NAIVE = "greatest(coalesce([lag_1,lag_2,lag_3,lag_4,lag_5,lag_6,lag_7][7 - (horizon - 1) % 7], 0.0), 0.0)"
_AVERAGE = "greatest(coalesce(rolling_mean_28, 0.0), 0.0)"
_POINT = f"SELECT {IDS}, origin_day, origin_date, horizon, target_date"
cte("points", f"""
{_POINT}, target, target_sell_price AS unit_price, 'seasonal_naive' AS model_name, {_NAIVE} AS yhat FROM train
UNION ALL
{_POINT}, target, target_sell_price, 'moving_average', {_AVERAGE} FROM train""", "train")
cte("folds", "SELECT CAST(unnest([2387, 2415, 2443]) AS INT) AS fold_origin")
cte("known", """
SELECT p.*, fold_origin, target - yhat AS residual
FROM points p JOIN folds ON origin_day < fold_origin AND origin_day + horizon <= fold_origin""", "points", "folds")
_Q = ", ".join(f"quantile_cont(residual, {q}) AS o{n}" for q, n in ((0.05, "05"), (0.5, "50"), (0.95, "95")))
cte("offsets", f"""
SELECT model_name, fold_origin, horizon, {_Q} FROM known GROUP BY ALL
UNION ALL
SELECT model_name, fold_origin, NULL, {_Q} FROM known GROUP BY ALL""", "known")
_SORTED = "list_sort([greatest(yhat + o05, 0.0), greatest(yhat + o50, 0.0), greatest(yhat + o95, 0.0)])"
cte("backtests", f"""
SELECT {IDS}, origin_day, fold_origin, origin_date, origin_day + horizon AS day_num, horizon, target_date, model_name,
       target, yhat, qs[1] AS q05, qs[2] AS q50, qs[3] AS q95, unit_price
FROM (SELECT p.*, o.fold_origin, {_SORTED} AS qs
      FROM points p JOIN offsets o ON o.model_name = p.model_name AND o.fold_origin = p.origin_day
           AND o.horizon = p.horizon)""", "points", "offsets")
cte("final_offsets", f"""
SELECT model_name, horizon, {_Q} FROM (SELECT model_name, horizon, target - yhat AS residual FROM points
 WHERE origin_day + horizon <= {ORIGIN}) GROUP BY ALL""", "points")
cte("winner", "SELECT model_name FROM judged ORDER BY eligible DESC, mean_wrmsse, model_name LIMIT 1", "judged")
cte("forecasts", f"""
SELECT {IDS}, origin_day, origin_date, horizon, target_date, unit_price, model_name, yhat,
       qs[1] AS q05, qs[2] AS q50, qs[3] AS q95
FROM (SELECT f.*, {_SORTED} AS qs FROM
      ({_POINT}, target_sell_price AS unit_price, 'moving_average' AS model_name, {_AVERAGE} AS yhat FROM future
       UNION ALL {_POINT}, target_sell_price, 'seasonal_naive', {_NAIVE} FROM future) f
      JOIN final_offsets USING (model_name, horizon) JOIN winner USING (model_name))""", "future", "final_offsets", "winner")


def _bridge_sql() -> str:
    parts = []
    for n, columns in enumerate(LEVELS, start=1):
        node = " || '/' || ".join(columns) or "'Total'"
        parts.append(f"SELECT series_id, {n} AS level, '{'/'.join(columns) or 'total'}' AS level_name, {node} AS node_id FROM k")
    return f"WITH k AS (SELECT DISTINCT {IDS} FROM sales) " + " UNION ALL ".join(parts)


cte("bridge", _bridge_sql(), "sales")
cte("nodes", f"""
SELECT level, level_name, node_id, day_num, sum(units) AS units, sum(units * coalesce(sell_price, 0.0)) AS revenue
FROM daily JOIN bridge USING (series_id) WHERE day_num <= {ORIGIN} GROUP BY ALL""", "daily", "bridge")
cte("scales", """
WITH firsts AS (SELECT fold_origin, level, node_id, min(day_num) AS first_day
                FROM nodes, folds WHERE units > 0 AND day_num <= fold_origin GROUP BY ALL),
     moves AS (SELECT fold_origin, level, node_id,
                      units - lag(units) OVER (PARTITION BY fold_origin, level, node_id ORDER BY day_num) AS move
               FROM nodes JOIN firsts USING (level, node_id) WHERE day_num >= first_day AND day_num <= fold_origin),
     scale AS (SELECT fold_origin, level, node_id, avg(move * move) AS scale FROM moves GROUP BY ALL),
     money AS (SELECT fold_origin, level, level_name, node_id, sum(revenue) AS node_revenue FROM nodes, folds
               WHERE day_num <= fold_origin AND day_num > fold_origin - 28 GROUP BY ALL)
SELECT level, level_name, node_id, fold_origin, scale, node_revenue,
       node_revenue / greatest(sum(node_revenue) OVER (PARTITION BY level, fold_origin), 1e-12) / 12 AS weight
FROM money LEFT JOIN scale USING (fold_origin, level, node_id)""", "nodes", "folds")
cte("details", """
WITH sums AS (SELECT model_name, fold_origin, level, level_name, node_id, day_num, sum(target) AS t, sum(yhat) AS y
              FROM backtests JOIN bridge USING (series_id) GROUP BY ALL),
     errors AS (SELECT model_name, fold_origin, level, level_name, node_id, avg((t - y) * (t - y)) AS mse
                FROM sums GROUP BY ALL)
SELECT model_name, fold_origin, level, level_name, node_id, rmsse, weight, rmsse * weight AS weighted_rmsse
FROM (SELECT e.*, weight, CASE WHEN scale > 0 THEN sqrt(mse / scale) ELSE 0.0 END AS rmsse
      FROM errors e LEFT JOIN scales s USING (fold_origin, level, node_id))""", "backtests", "bridge", "scales")
cte("scores", """
SELECT model_name, fold_origin, sum(weighted_rmsse) AS wrmsse,
       avg(rmsse) FILTER (level = 12 AND isfinite(rmsse)) AS bottom_rmsse
FROM details GROUP BY ALL""", "details")

POINT_SQL = """avg(abs(yhat - target)) AS mae, sqrt(avg((yhat - target) * (yhat - target))) AS rmse,
 sum(abs(yhat - target)) / greatest(sum(abs(target)), 1e-12) AS wape,
 sum(yhat - target) / greatest(sum(abs(target)), 1e-12) AS bias"""
POINT_COLUMNS = ["mae", "rmse", "wape", "bias"]


def _pinball(column: str, level: str) -> str:
    return f"avg(greatest({level} * (target - {column}), ({level} - 1) * (target - {column})))"


INTERVAL_SQL = f"""avg(CAST(target >= q05 AND target <= q95 AS DOUBLE)) AS coverage, avg(q95 - q05) AS mean_interval_width,
 {_pinball('q05', '0.05')} AS pinball_q05, {_pinball('q50', '0.5')} AS pinball_q50, {_pinball('q95', '0.95')} AS pinball_q95,
 ({_pinball('q05', '0.05')} + {_pinball('q50', '0.5')} + {_pinball('q95', '0.95')}) / 3 AS mean_pinball_loss"""
INTERVAL_COLUMNS = ["coverage", "mean_interval_width", "pinball_q05", "pinball_q50", "pinball_q95", "mean_pinball_loss"]
METRICS = [*POINT_COLUMNS, *INTERVAL_COLUMNS]

cte("by_fold", f"SELECT model_name, fold_origin, {POINT_SQL}, {INTERVAL_SQL} FROM backtests GROUP BY ALL", "backtests")
cte("averaged", "SELECT model_name, " + ", ".join(f"avg({m}) AS {m}" for m in METRICS) + " FROM by_fold GROUP BY ALL", "by_fold")
_GRAINS = {
    "sku_store_28d": "series_id", "store_day": "store_id, target_date", "store_category_day": "store_id, cat_id, target_date",
    "total_day": "target_date", "sku_store_week": "series_id, week", "store_category_week": "store_id, cat_id, week",
}
cte("granular", "WITH b AS (SELECT *, (horizon - 1) // 7 + 1 AS week FROM backtests), summed AS ("
    + " UNION ALL ".join(
        [f"SELECT model_name, fold_origin, 'sku_store_day' AS granularity, target, yhat FROM b"]
        + [f"SELECT model_name, fold_origin, '{n}', sum(target), sum(yhat) FROM b GROUP BY model_name, fold_origin, {g}" for n, g in _GRAINS.items()])
    + f"), m AS (SELECT model_name, fold_origin, granularity, {POINT_SQL} FROM summed GROUP BY ALL) "
    + "SELECT model_name, granularity, " + ", ".join(f"avg({m}) AS {m}" for m in POINT_COLUMNS) + " FROM m GROUP BY ALL", "backtests")
GRAIN_NAMES = ["sku_store_day", *_GRAINS]
cte("degradation", """
SELECT s.model_name, greatest(max(s.wrmsse / greatest(b.wrmsse, 1e-12) - 1), 0.0) AS max_fold_degradation
FROM scores s JOIN scores b ON b.fold_origin = s.fold_origin AND b.model_name = 'seasonal_naive' GROUP BY ALL""", "scores")
cte("summary", """
SELECT model_name, mean_wrmsse, mae, rmse, wape, bias, coverage, mean_interval_width, mean_pinball_loss, bottom_rmsse,
       max_fold_degradation
FROM (SELECT model_name, avg(wrmsse) AS mean_wrmsse, avg(bottom_rmsse) AS bottom_rmsse FROM scores GROUP BY ALL)
JOIN averaged USING (model_name) JOIN degradation USING (model_name)""", "scores", "averaged", "degradation")
cte("judged", """
SELECT *, abs(bias) <= 0.05 AND coverage BETWEEN 0.85 AND 0.95 AND max_fold_degradation <= 0.05 AS eligible FROM summary""", "summary")

# Inventory.
cte("blocks", """
SELECT model_name, fold_origin, series_id, list(residual ORDER BY horizon) AS block
FROM (SELECT k.*, h AS horizon, coalesce(r, 0.0) AS residual
      FROM (SELECT DISTINCT model_name, fold_origin, series_id FROM backtests) k CROSS JOIN steps
      LEFT JOIN (SELECT model_name, fold_origin, series_id, horizon, avg(target - yhat) AS r FROM backtests GROUP BY ALL) v
           ON v.model_name = k.model_name AND v.fold_origin = k.fold_origin AND v.series_id = k.series_id AND v.horizon = h)
GROUP BY ALL""", "backtests", "steps")
cte("numbered", """
SELECT *, row_number() OVER (PARTITION BY model_name
            ORDER BY md5(fold_origin || ':' || series_id || ':42'), fold_origin, series_id) - 1 AS row_index,
       count(*) OVER (PARTITION BY model_name) AS n
FROM blocks""", "blocks")
cte("sample", """
SELECT k.model_name, draw, path, block
FROM (SELECT model_name, CAST(draw AS INT) AS draw, path,
             ('0x' || substr(md5((42 + draw) || ':' || path), 1, 8))::BIGINT % n AS pick
      FROM (SELECT DISTINCT model_name, n FROM numbered) CROSS JOIN range(0, 1000) p(path)
           CROSS JOIN (VALUES (0), (7), (14), (21)) d(draw)) k
JOIN numbered b ON b.model_name = k.model_name AND b.row_index = pick""", "numbered")
cte("latest", """
SELECT *, CAST(row_number() OVER (PARTITION BY model_name, series_id ORDER BY target_date) - 1 AS INT) AS day_index
FROM backtests WHERE fold_origin = (SELECT max(fold_origin) FROM backtests)""", "backtests")
cte("levels", """
WITH sums AS (SELECT w.model_name, w.series_id, w.day_index AS draw, s.path,
                     sum(greatest(f.yhat + s.block[f.day_index - w.day_index + 1], 0.0)) AS total
              FROM latest w JOIN latest f ON f.model_name = w.model_name AND f.series_id = w.series_id
                   AND f.day_index >= w.day_index AND f.day_index < w.day_index + 14
              JOIN sample s ON s.model_name = w.model_name AND s.draw = w.day_index
              WHERE w.day_index % 7 = 0 GROUP BY ALL)
SELECT 'base' AS policy, model_name, series_id, draw AS day_index, quantile_cont(total, 0.95) AS level
FROM sums GROUP BY model_name, series_id, draw""", "latest", "sample")
cte("advice", """
WITH ordered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY target_date) AS k FROM forecasts),
     sums AS (SELECT series_id, path, min(origin_date) AS as_of_date,
                     sum(greatest(yhat + block[k], 0.0)) FILTER (k <= 7) AS near,
                     sum(greatest(yhat + block[k], 0.0)) AS far
              FROM ordered o JOIN sample s ON s.model_name = o.model_name AND s.draw = 0 WHERE k <= 14 GROUP BY ALL),
     lv AS (SELECT series_id, min(as_of_date) AS as_of_date, quantile_cont(near, 0.95) AS r, quantile_cont(far, 0.95) AS s
            FROM sums GROUP BY series_id)
SELECT series_id, as_of_date, 7 AS lead_time_days, 7 AS review_period_days, CAST(0.95 AS DOUBLE) AS service_level,
       r AS on_hand, r AS reorder_point, s AS order_up_to, greatest(s - r, 0.0) AS suggested_order_quantity,
       'synthetic_configurable' AS assumption_source
FROM lv""", "forecasts", "sample")

# Attribution.
WEIGHTS = {
    "lag_1": "0.05", "lag_7": "0.1", "lag_28": "-0.08", "rolling_mean_7": "0.4", "rolling_mean_28": "0.6",
    "nonzero_rate_28": "1.5", "days_since_last_sale": "-0.02", "target_wday": "0.3", "target_month": "-0.2",
    "target_snap_CA": "0.7", "target_sell_price": "0.00001", "price_missing": "-0.9", "horizon": "-0.01",
}


def _attribution_sql() -> str:
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS x_{c}" for c in WEIGHTS)
    means = ", ".join(f"avg(x_{c}) AS m_{c}" for c in WEIGHTS)
    shap = {c: f"({w}::DOUBLE * (x_{c} - m_{c}))" for c, w in WEIGHTS.items()}
    base = "1.0 + " + " + ".join(f"{w}::DOUBLE * m_{c}" for c, w in WEIGHTS.items())
    return (
        f"WITH x AS (SELECT series_id, horizon, {filled} FROM train WHERE origin_day = 2443), m AS (SELECT {means} FROM x) "
        "SELECT series_id, horizon, " + ", ".join(f"{e} AS shap_{c}" for c, e in shap.items()) + ", "
        + ", ".join(f"x_{c} AS feature_{c}" for c in WEIGHTS)
        + f", {base} AS base_value, {base} + {' + '.join(shap.values())} AS model_output FROM x, m"
    )


cte("attr", _attribution_sql(), "train")
cte("attr_long", " UNION ALL ".join(f"SELECT series_id, horizon, '{c}' AS feature, shap_{c} AS value FROM attr" for c in WEIGHTS), "attr")
cte("attr_global", """
SELECT row_number() OVER (ORDER BY mean_abs_shap DESC, feature) AS rank, *,
       mean_abs_shap / greatest(sum(mean_abs_shap) OVER (), 1e-12) AS importance_share,
       CASE WHEN ends_with(feature, '_id') THEN 'Identifiers' WHEN contains(feature, 'price') THEN 'Price'
            WHEN feature IN ('origin_day', 'horizon') OR starts_with(feature, 'target_wday') OR starts_with(feature, 'target_month')
                 OR starts_with(feature, 'target_event') OR starts_with(feature, 'target_snap') THEN 'Calendar and horizon'
            WHEN regexp_matches(feature, '^(target_lag_|lag_|rolling_|nonzero_|days_since_|short_long_)') THEN 'Demand history'
            ELSE 'Other' END AS feature_group
FROM (SELECT feature, avg(abs(value)) AS mean_abs_shap, avg(value) AS mean_shap,
             avg(CAST(value > 0 AS DOUBLE)) AS positive_share, avg(CAST(value < 0 AS DOUBLE)) AS negative_share
      FROM attr_long GROUP BY ALL)""", "attr_long")
cte("attr_horizon", """
SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mean_abs_shap DESC, feature) AS rank
FROM (SELECT horizon, feature, avg(abs(value)) AS mean_abs_shap FROM attr_long GROUP BY ALL)""", "attr_long")
cte("attr_total", "SELECT series_id, horizon, sum(abs(value)) AS total FROM attr_long GROUP BY ALL", "attr_long")
