from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import attribution, contracts, inventory
from demandloom.settings import ReplayPolicy


def days_frame(spark, demand, yhat, price=10.0):
    start = date(2025, 1, 1)
    return spark.createDataFrame(
        [("m", "s", 1, start + timedelta(days=i), i + 1, d, y, price) for i, (d, y) in enumerate(zip(demand, yhat))],
        "model_name string, series_id string, fold_origin int, target_date date, horizon int, target double, yhat double, unit_price double",
    )


def test_levels_of_a_four_day_case(spark):
    policy = ReplayPolicy(name="p", lead_days=1, review_days=1, paths=100, initial_on_hand=4.0)
    frame = days_frame(spark, [2.0, 3.0, 1.0, 2.0], [2.0] * 4)
    blocks = spark.createDataFrame([("m", 1, "s", [0.0] * 4), ("m", 1, "t", [0.0] * 4)], "model_name string, fold_origin int, series_id string, block array<double>")
    levels = inventory.review_levels(frame, blocks, [policy], 4, 42)
    assert [r["level"] for r in levels.orderBy("day_index").collect()] == [4.0, 4.0, 4.0, 2.0]


def test_order_up_to_equals_numpy_on_the_same_sample(spark):
    rng = np.random.default_rng(0)
    horizon, days = 6, 9
    blocks = [(f"s{i}", rng.normal(0, 2, horizon).tolist()) for i in range(40)]
    frame = spark.createDataFrame([("m", 1, s, b) for s, b in blocks], "model_name string, fold_origin int, series_id string, block array<double>")
    samples = inventory.sampled_paths(frame, [0, 7], 200, 42)
    points = {("a", 0): rng.uniform(0, 3, days).tolist(), ("b", 7): rng.uniform(0, 3, 4).tolist(), ("c", 0): []}
    windows = spark.createDataFrame([("m", s, d, 0.9, p) for (s, d), p in points.items()] + [("other", "d", 0, 0.9, [1.0, 2.0])], "model_name string, series_id string, draw int, service_level double, point array<double>")
    got = {r["series_id"]: r["level"] for r in inventory.order_up_to(windows, samples).collect()}
    drawn = {r["draw"]: np.array(r["sample"]) for r in samples.collect()}
    assert drawn[0].shape == (200, horizon) and not np.array_equal(drawn[0], drawn[7])
    for (s, d), p in points.items():
        tiled = np.tile(drawn[d], (1, 2))[:, : len(p)]
        expected = np.quantile(np.maximum(np.array(p) + tiled, 0).sum(axis=1), 0.9) if p else 0.0
        assert got[s] == pytest.approx(expected)
    assert got["d"] == 3.0
    again = inventory.sampled_paths(frame.repartition(7), [0, 7], 200, 42)
    assert {r["draw"]: r["sample"] for r in again.collect()} == {r["draw"]: r["sample"] for r in samples.collect()}


def test_residual_blocks_fill_gaps_and_can_exclude_a_fold(spark):
    frame = days_frame(spark, [5.0, 1.0], [2.0, 3.0]).where("horizon <> 2")
    block = inventory.residual_blocks(frame, 3).first()["block"]
    assert block == [3.0, 0.0, 0.0]
    assert inventory.residual_blocks(frame, 3, exclude_fold=1).isEmpty()


def test_prices_are_taken_from_features_only_when_absent(spark):
    backtests = spark.createDataFrame([("s", 1, 1)], "series_id string, origin_day int, horizon int")
    features = spark.createDataFrame([("s", 1, 1, 4.0), ("s", 1, 1, 4.0)], "series_id string, origin_day int, horizon int, target_sell_price double")
    assert inventory.with_unit_price(backtests, features).collect()[0]["unit_price"] == 4.0
    priced = backtests.withColumn("unit_price", F.lit(9.0))
    assert inventory.with_unit_price(priced, features).first()["unit_price"] == 9.0


@pytest.fixture(scope="module")
def shap(spark):
    return spark.createDataFrame(
        [
            ("FOODS_1_001_CA_1", 1, 2.0, 0.5, 0.1, 0.0), ("FOODS_1_001_CA_1", 2, -2.0, 0.5, 0.1, 0.2),
            ("HOUSEHOLD_1_001_TX_2", 1, 1.0, -0.5, 0.1, 0.0), ("HOUSEHOLD_1_001_TX_2", 2, -1.0, -0.5, 0.1, 0.2),
        ],
        "series_id string, horizon int, shap_rolling_mean_28 double, shap_target_wday double, shap_store_id double, shap_origin_sell_price double",
    )


def test_attribution_views(shap):
    top = attribution.attribution_global(shap).orderBy("rank").collect()
    assert top[0]["feature"] == "rolling_mean_28" and top[0]["positive_share"] == 0.5
    assert sum(r["importance_share"] for r in top) == pytest.approx(1.0)
    assert {r["feature_group"] for r in top} == {"Demand history", "Calendar and horizon", "Identifiers", "Price"}
    assert attribution.attribution_global(shap, top=2).count() == 2
    leaders = attribution.attribution_horizon(shap).where("rank = 1").collect()
    assert {r["feature"] for r in leaders} == {"rolling_mean_28"} and len(leaders) == 2
    segments = attribution.attribution_segment(shap).collect()
    assert {r["segment_type"] for r in segments} == {"state", "store", "category"}
    assert {r["segment"] for r in segments if r["segment_type"] == "store"} == {"CA_1", "TX_2"}
    foods = next(r for r in segments if r["segment"] == "FOODS")
    assert foods["top_feature"] == "rolling_mean_28" and foods["top_feature_mean_abs_shap"] == pytest.approx(2.0)
    local = attribution.attribution_local(shap, 2).orderBy("horizon").collect()
    assert len(local) == 2 and local[0]["top_driver"] == "rolling_mean_28"
    assert local[1]["direction"] == "lowers forecast"
    assert local[0]["top_three_drivers"] == "rolling_mean_28 (+2.000); target_wday (+0.500); store_id (+0.100)"
    summary = attribution.attribution_summary(shap).first()
    assert (summary["sample_rows"], summary["series_count"], summary["top_feature_horizon_count"]) == (4, 2, 2)
    assert summary["top_five_share"] == pytest.approx(1.0)


def test_attribution_contract(spark):
    bare = spark.createDataFrame([("a", 1)], "series_id string, horizon int")
    with pytest.raises(ValueError, match="shap_<feature>"):
        attribution.attribution_global(bare)
    with pytest.raises(ValueError, match="missing columns"):
        attribution.attribution_global(bare.drop("horizon"))


def test_linear_attribution_adds_up(spark):
    frame = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, None)], "series_id string, horizon int, x double")
    rows = attribution.linear_attribution(frame, {"x": 2.0, "horizon": -1.0}, 0.5).collect()
    for r in rows:
        assert r["base_value"] + r["shap_x"] + r["shap_horizon"] == pytest.approx(r["model_output"])
        assert r["model_output"] == pytest.approx(0.5 + 2 * r["feature_x"] - r["feature_horizon"])
    assert sum(r["shap_x"] for r in rows) == pytest.approx(0.0)


def test_record_rules(spark):
    good = (1, 2.0, 1.0, 2.0, 3.0)
    frame = spark.createDataFrame([good, (1, 2.0, 3.0, 2.0, 1.0), (0, -1.0, 0.0, 0.0, 0.0)], "horizon int, yhat double, q05 double, q50 double, q95 double")
    broken = contracts.violations(frame, contracts.forecast_rules())
    assert {r["broken_rule"] for r in broken.collect()} == {"quantiles_ordered", "horizon_positive", "yhat_not_negative"}
    with pytest.raises(ValueError, match="unexpected"):
        contracts.require_exact_columns(frame, ["horizon", "yhat", "q05", "q50"])
