from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import accuracy, adjust, baselines, hierarchy, selection
from demandloom.settings import HIERARCHY, Guardrails


@pytest.fixture(scope="module")
def backtests(panel, small):
    from demandloom.operators.features import build_direct_features

    daily, days = panel
    return baselines.backtest_baselines(build_direct_features(daily, days, small), small).persist()


def test_seasonal_naive_repeats_the_week(spark):
    frame = spark.createDataFrame(
        [(h, *[10.0 * k for k in range(1, 8)]) for h in range(1, 15)], "horizon int, " + ", ".join(f"lag_{k} double" for k in range(1, 8))
    )
    got = [r[0] for r in frame.orderBy("horizon").select(baselines.seasonal_naive()).collect()]
    assert got == [70.0, 60.0, 50.0, 40.0, 30.0, 20.0, 10.0] * 2


def test_moving_average_is_clipped(spark):
    frame = spark.createDataFrame([(-1.0,), (2.5,), (None,)], "rolling_mean_28 double")
    assert [r[0] for r in frame.select(baselines.moving_average()).collect()] == [0.0, 2.5, 0.0]


def test_calibration_is_monotone_and_falls_back(spark):
    fit = spark.createDataFrame(
        [("m", 1, h, 5.0 + r, 5.0) for h in (1, 2) for r in range(-2, 4)], "model_name string, fold_origin int, horizon int, target double, yhat double"
    )
    points = spark.createDataFrame([("m", 1, 1, 5.0), ("m", 1, 99, 1.0)], "model_name string, fold_origin int, horizon int, yhat double")
    got = {r["horizon"]: r for r in baselines.apply_calibration(points, baselines.fit_calibration(fit)).collect()}
    q = np.quantile(np.arange(-2, 4), [0.05, 0.5, 0.95])
    assert [got[1][c] for c in ("q05", "q50", "q95")] == pytest.approx(list(5 + q))
    # The fallback pools both horizons: every residual occurs twice.
    pooled = np.quantile(np.repeat(np.arange(-2, 4), 2), [0.05, 0.5, 0.95])
    assert [got[99][c] for c in ("q05", "q50", "q95")] == pytest.approx(list(np.maximum(1 + pooled, 0)))


def test_level_factor_bounds(spark):
    frame = spark.createDataFrame(
        [("up", 2.0, 1.0), ("up", 4.0, 2.0), ("down", 1.0, 2.0), ("down", 2.0, 4.0), ("none", 1.0, 0.0)], "k string, target double, yhat double"
    )
    assert {r["k"]: r["level_factor"] for r in baselines.level_factor(frame, ["k"]).collect()} == {"up": 1.25, "down": 0.8, "none": 1.0}


def test_backtest_contract_repairs_dates_and_prices(spark):
    ids = "'i_s' AS series_id, 'i' AS item_id, 'd' AS dept_id, 'c' AS cat_id, 's' AS store_id, 'CA' AS state_id, 1913 AS origin_day, 1913 AS fold_origin, 1 AS horizon, date'2016-04-25' AS target_date, 2.0D AS target, 2.1D AS yhat, 1.0D AS q05, 2.1D AS q50, 3.5D AS q95"
    a = spark.sql(f"SELECT {ids}, date'2016-04-24' AS origin_date, 'a' AS model_name, 4.25D AS target_sell_price")
    b = spark.sql(f"SELECT {ids}, 'b' AS model_name, 4.25D AS sell_price")
    got = baselines.backtest_contract(a, b)
    assert got.columns == list(baselines.CONTRACT) and len(got.columns) == 19
    assert {(r["origin_date"], r["unit_price"], r["day_num"]) for r in got.collect()} == {(date(2016, 4, 24), 4.25, 1914)}


def test_splits(panel, small):
    from demandloom.operators.features import build_direct_features

    daily, days = panel
    built = build_direct_features(daily, days, small)
    train, evaluation = baselines.split_fold(built, 51)
    assert train.agg(F.max(F.col("origin_day") + F.col("horizon"))).first()[0] <= 51 and evaluation.count() == 12
    fit, validation = baselines.validation_split(train)
    assert validation.select("origin_day").distinct().count() == 1 and fit.agg(F.max("origin_day")).first()[0] < 51
    with pytest.raises(ValueError):
        baselines.split_fold(built, 2)


def test_point_metrics(spark):
    perfect = spark.createDataFrame([(float(x),) * 5 for x in range(3)], "target double, yhat double, q05 double, q50 double, q95 double")
    row = accuracy.point_metrics(perfect, []).first()
    assert (row["mae"], row["rmse"], row["wape"], row["coverage"], row["mean_pinball_loss"]) == (0, 0, 0, 1, 0)
    low = spark.createDataFrame([(10.0, 8.0)], "target double, q double")
    from demandloom.functions.exprs import pinball

    assert low.select(pinball(F.col("target"), F.col("q"), 0.95)).first()[0] == pytest.approx(1.9)
    assert low.select(pinball(F.lit(10.0), F.lit(12.0), 0.95)).first()[0] == pytest.approx(0.1)
    with pytest.raises(ValueError):
        pinball(F.lit(1.0), F.lit(1.0), 1.0)
    biased = spark.createDataFrame([(1.0, 2.0)] * 2, "target double, yhat double")
    assert accuracy.point_metrics(biased, [], intervals=False).first()["bias"] == pytest.approx(1.0)


def test_fold_means_and_empty_input(spark):
    schema = "model_name string, fold_origin int, target double, yhat double, q05 double, q50 double, q95 double"
    frame = spark.createDataFrame(
        [("a", 1, 1.0, 2.0, 0.0, 2.0, 3.0), ("a", 1, 3.0, 2.0, 1.0, 2.0, 4.0), ("a", 2, 2.0, 2.0, 1.0, 2.0, 3.0), ("a", 2, 4.0, 4.0, 3.0, 4.0, 5.0)], schema
    )
    row = accuracy.backtest_summary(frame).first()
    assert [row[c] for c in ("mae", "wape", "bias", "coverage")] == pytest.approx([0.5, 0.25, 0.0, 1.0])
    empty = accuracy.backtest_summary(frame.where("false"))
    assert empty.isEmpty() and "wape" in empty.columns
    with pytest.raises(ValueError, match="q95"):
        accuracy.backtest_summary(frame.drop("q95"))


def test_granularity_sums_before_dividing(spark):
    frame = spark.createDataFrame(
        [("a", 1, s, "store", "cat", date(2025, 1, h), h, t, 1.0) for s, h, t in (("a", 1, 0.0), ("b", 1, 2.0), ("a", 2, 2.0), ("b", 2, 0.0))],
        "model_name string, fold_origin int, series_id string, store_id string, cat_id string, target_date date, horizon int, target double, yhat double",
    )
    got = {r["granularity"]: r["wape"] for r in accuracy.wape_by_granularity(frame).collect()}
    assert len(got) == 7
    assert (got["sku_store_day"], got["store_day"], got["sku_store_28d"]) == (1.0, 0.0, 0.0)
    assert set(accuracy.wape_pivot(accuracy.wape_by_granularity(frame)).columns) == {"model_name", *got}


def brute_wrmsse(history, forecast, origin):
    """Direct computation over twelve levels with pandas."""
    total, nodes = 0.0, 0
    history = history[history.day_num <= origin]
    for columns in HIERARCHY:
        key = (lambda f: f[list(columns)].agg("/".join, axis=1)) if columns else (lambda f: f.day_num.map(lambda _: "Total"))
        h = history.assign(node=key(history), revenue=history.units * history.sell_price.fillna(0))
        f = forecast.assign(node=key(forecast))
        recent = h[h.day_num > origin - 28]
        for node, part in f.groupby("node"):
            daily = part.groupby("day_num")[["target", "yhat"]].sum()
            train = h[h.node == node].groupby("day_num").units.sum().sort_index()
            sold = np.flatnonzero(train.to_numpy() > 0)
            scale = np.mean(np.diff(train.to_numpy()[sold[0]:]) ** 2) if len(sold) and len(train) - sold[0] > 1 else 0
            score = np.sqrt(((daily.target - daily.yhat) ** 2).mean() / scale) if scale > 0 else 0.0
            total += score * recent[recent.node == node].revenue.sum() / recent.revenue.sum() / 12
            nodes += 1
    return total, nodes


def test_wrmsse_equals_brute_force_for_all_folds_at_once(panel, small, backtests):
    daily, _ = panel
    details = hierarchy.hierarchical_wrmsse(daily, backtests, small.backtest_origins).persist()
    scores = {(r["model_name"], r["fold_origin"]): r["wrmsse"] for r in hierarchy.fold_scores(details).collect()}
    assert len(scores) == 6
    history, forecasts = daily.toPandas(), backtests.toPandas()
    for (model, fold), score in scores.items():
        part = forecasts[(forecasts.model_name == model) & (forecasts.fold_origin == fold)]
        expected, nodes = brute_wrmsse(history, part, fold)
        assert score == pytest.approx(expected)
        assert details.where((F.col("model_name") == model) & (F.col("fold_origin") == fold)).count() == nodes
    weights = details.where("model_name = 'moving_average'").groupBy("fold_origin").agg(F.sum("weight")).collect()
    assert [w[1] for w in weights] == pytest.approx([1.0] * 3)
    infinite = hierarchy.hierarchical_wrmsse(daily, backtests.withColumn("yhat", F.col("yhat") + 1), small.backtest_origins, "inf")
    dead = infinite.where("node_id = 'CA_2/HOBBIES_1_002'").select("rmsse").distinct().collect()
    assert [r[0] for r in dead] == [float("inf")]


def test_perfect_forecast_scores_zero(spark):
    dims = "'item_CA_1' AS series_id, 'item' AS item_id, 'dept' AS dept_id, 'cat' AS cat_id, 'CA_1' AS store_id, 'CA' AS state_id"
    history = spark.sql(f"SELECT {dims}, CAST(id AS INT) AS day_num, CAST(id AS DOUBLE) AS units, 2.0D AS sell_price FROM range(1, 10)")
    forecast = spark.sql(f"SELECT {dims}, 'm' AS model_name, 9 AS fold_origin, CAST(id AS INT) AS day_num, CAST(id AS DOUBLE) AS target, CAST(id AS DOUBLE) AS yhat FROM range(10, 13)")
    details = hierarchy.hierarchical_wrmsse(history, forecast, [9])
    assert {r["level"] for r in details.collect()} == set(range(1, 13))
    assert hierarchy.fold_scores(details).first()["wrmsse"] == 0


def test_series_rmsse_ignores_leading_zeros(spark):
    history = spark.createDataFrame([("a", d, u) for d, u in enumerate([0.0, 0.0, 1.0, 2.0, 4.0])] + [("flat", d, 0.0) for d in range(5)], "series_id string, day_num int, units double")
    forecast = spark.createDataFrame([("a", 3.0, 4.0), ("a", 4.0, 4.0), ("flat", 0.0, 1.0)], "series_id string, target double, yhat double")
    got = {r["series_id"]: r["rmsse"] for r in hierarchy.series_rmsse(history, forecast).collect()}
    assert got["a"] == pytest.approx(np.sqrt(0.5 / 2.5)) and got["flat"] == float("inf")


def test_rollup_equals_bridge(panel, backtests):
    daily, _ = panel
    rows = backtests.where("model_name = 'moving_average' AND fold_origin = 54")
    keys = ["target_date", "horizon"]
    order = ["level", "node_id", *keys]
    a = hierarchy.hierarchy_rollup(rows, ["yhat", "q95"], keys).orderBy(*order).collect()
    b = hierarchy.bridge_rollup(rows, hierarchy.build_bridge(daily), ["yhat", "q95"], keys).orderBy(*order).collect()
    assert [tuple(r[c] for c in order) for r in a] == [tuple(r[c] for c in order) for r in b]
    assert [r["yhat"] for r in a] == pytest.approx([r["yhat"] for r in b])
    totals = {}
    for r in a:
        totals[r["level"]] = totals.get(r["level"], 0.0) + r["yhat"]
    assert len(totals) == 12 and max(totals.values()) == pytest.approx(min(totals.values()))


def test_bottom_rmsse_averages_finite_bottom_rows(spark):
    details = spark.createDataFrame(
        [("a", 1, 11, 9.0, 0.1), ("a", 1, 12, 0.5, 0.1), ("a", 1, 12, 1.5, 0.1), ("a", 1, 12, float("inf"), 0.0)],
        "model_name string, fold_origin int, level int, rmsse double, weighted_rmsse double",
    )
    assert hierarchy.bottom_rmsse(details).first()["bottom_rmsse"] == pytest.approx(1.0)


def test_winner_and_promotion(spark):
    schema = "model_name string, mean_wrmsse double, bias double, coverage double, max_fold_degradation double"
    table = spark.createDataFrame([("biased", 0.8, -0.08, 0.9, 0.0), ("eligible", 1.0, -0.02, 0.89, 0.0)], schema)
    rails = Guardrails()
    assert selection.select_winner(table, rails).first()["model_name"] == "eligible"
    nobody = table.where("model_name = 'biased'")
    assert selection.select_winner(nobody, rails).first()["model_name"] == "biased"
    gate = {r["model_name"]: r for r in selection.promotion_gate(table, table.where("model_name = 'eligible'"), rails).collect()}
    assert gate["biased"]["reasons"] == ["bias_guardrail"] and not gate["biased"]["promoted"]
    assert gate["eligible"]["reasons"] == ["insufficient_wrmsse_improvement"]
    alone = selection.promotion_gate(table, table.where("false"), rails).where("model_name = 'eligible'").first()
    assert alone["promoted"]


def test_degradation_is_worst_fold_and_never_negative(spark):
    scores = spark.createDataFrame(
        [("seasonal_naive", 1, 1.0), ("seasonal_naive", 2, 2.0), ("m", 1, 1.2), ("m", 2, 1.0), ("good", 1, 0.5), ("good", 2, 0.5)],
        "model_name string, fold_origin int, wrmsse double",
    )
    got = {r["model_name"]: r["max_fold_degradation"] for r in selection.fold_degradation(scores).collect()}
    assert got["m"] == pytest.approx(0.2) and got["good"] == 0.0 and got["seasonal_naive"] == 0.0


def test_grids_equal_exhaustive_search(spark):
    rng = np.random.default_rng(1)
    y = rng.poisson(1.5, 400).astype(float)
    p = np.maximum(y * 0.7 + rng.normal(0.6, 0.8, 400), 0)
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "target double, yhat double")
    best = min(
        ((round(np.abs(np.where(p < t, 0, p) * s - y).sum() / y.sum(), 10), t, s) for t in adjust.THRESHOLDS for s in adjust.SCALES)
    )
    got = adjust.threshold_scale_search(frame).first()
    assert (round(got["wape"], 10), got["threshold"], got["scale"]) == pytest.approx(best)
    open_scales = [
        (round(np.abs(p * s - y).sum() / y.sum(), 10), s) for s in adjust.WIDE_SCALES if abs((p * s - y).sum() / y.sum()) <= 0.05
    ]
    got = adjust.unbiased_scale_search(frame).first()
    assert (round(got["wape"], 10), got["scale"]) == pytest.approx(min(open_scales))
    assert adjust.unbiased_scale_search(frame.withColumn("yhat", F.lit(0.0))).isEmpty()


def test_group_scale_and_seasonal_mean(spark):
    fit = spark.createDataFrame([("a", 10.0, 5.0), ("b", 0.0, 500.0)], "store_id string, target double, yhat double")
    score = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("new", 1.0)], "store_id string, yhat double")
    got = {r["store_id"]: r["yhat"] for r in adjust.apply_group_scale(fit, score, ["store_id"], 5.0).collect()}
    assert got == pytest.approx({"a": 1.5, "b": 0.5, "new": 1.0})
    lags = spark.createDataFrame([(1.0, None, 3.0, None, None), (None,) * 5], ", ".join(f"target_lag_{k} double" for k in adjust.SEASONAL_LAGS))
    assert [r[0] for r in lags.select(adjust.seasonal_mean()).collect()] == [2.0, None]


def test_error_breakdowns_are_consistent(backtests):
    total = backtests.groupBy("model_name").agg(F.sum("target").alias("t")).collect()
    for table in (accuracy.regime_errors(backtests, "moving_average"), accuracy.horizon_errors(backtests)):
        again = {r["model_name"]: r["d"] for r in table.groupBy("model_name").agg(F.sum("demand").alias("d")).collect()}
        assert again == pytest.approx({r["model_name"]: r["t"] for r in total})
    segments = accuracy.segment_errors(backtests).groupBy("model_name", "dimension").agg(F.sum("demand").alias("d")).collect()
    assert len(segments) == 6 and len({round(r["d"], 6) for r in segments}) == 1
