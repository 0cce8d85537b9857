from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from demandloom.operators import contracts
from demandloom.operators.learned import (
    DirectForecaster, encode_categories, fit_categories, hurdle_forecast, load_forecaster, save_forecaster,
)
from demandloom.plans import jobs
from demandloom.settings import ReplayPolicy
from demandloom.sources import files
from demandloom.sources.tables import read_table


@pytest.fixture(scope="module")
def lake(spark, panel, small, tmp_path_factory):
    """Lake built from CSV sources by the ingestion, panel and feature jobs."""
    source, root = str(tmp_path_factory.mktemp("csv")), str(tmp_path_factory.mktemp("lake"))
    daily, days = panel
    ids = daily.withColumn("id", F.concat("series_id", F.lit("_evaluation")))
    wide = ids.groupBy(*files.SALES_IDENTIFIERS).pivot("day_num", list(range(1, 61))).agg(F.max(F.col("units").cast("int")))
    wide = wide.select(*files.SALES_IDENTIFIERS, *[F.col(str(d)).alias(f"d_{d}") for d in range(1, 61)])
    prices = daily.groupBy("store_id", "item_id", "wm_yr_wk").agg(F.max("sell_price").alias("sell_price"))
    for name, frame in {"sales_train_evaluation.csv": wide, "sell_prices.csv": prices, "calendar.csv": days.drop("day_num")}.items():
        frame.coalesce(1).write.option("header", True).csv(f"{source}/{name}")
    required = {
        "sales_train_evaluation.csv": ("id", "item_id", "d_1", "d_60"), "sell_prices.csv": ("store_id", "sell_price"), "calendar.csv": ("date", "d"),
    }
    bronze = jobs.run_bronze(spark, source, root, "r1", list(required), required)
    assert bronze["sales_train_evaluation"]["rows"] == 4 and bronze["calendar"]["rows"] == 60
    silver = jobs.run_silver(spark, root, small, "r1")
    assert silver["quality"]["row_count"] == 240 and silver["sales_daily"]["rows"] == 240
    gold = jobs.run_gold(spark, root, small, "r1")
    assert gold["training_features"]["rows"] == 4 * len(small.training_origins()) * small.horizon
    assert gold["forecast_features"]["rows"] == 12 and gold["hierarchy"]["rows"] == 48
    return root


def test_panel_read_back_equals_source(spark, lake, panel):
    daily, _ = panel
    stored = read_table(spark, lake, "silver", "sales_daily")
    keys = ["series_id", "day_num", "units"]
    assert stored.select(*keys).exceptAll(daily.select(*keys)).isEmpty()
    audit = files.lineage_audit({n: read_table(spark, lake, "bronze", n) for n in ("calendar", "sell_prices")})
    assert {r["lineage_records"] for r in audit.collect()} == {1}


def test_a_missing_source_stops_ingestion(spark, tmp_path):
    (tmp_path / "calendar.csv").write_text("date,d\n1995-01-02,d_1\n")
    with pytest.raises(ValueError, match="source files"):
        jobs.ingest_frames(spark, str(tmp_path), "r", ["calendar.csv", "sell_prices.csv"])


def test_forecast_inventory_and_evaluation_jobs(spark, lake, small):
    cfg = replace(small, tune_fraction=1.0, policy=ReplayPolicy(lead_days=1, review_days=1, paths=50))
    outcome = jobs.run_forecasting(spark, lake, cfg, "r2", models=("seasonal_naive", "moving_average", "tweedie"))
    metrics = read_table(spark, lake, "gold", "model_metrics")
    assert {r["model_name"] for r in metrics.collect()} == {"seasonal_naive", "moving_average", "tweedie"}
    assert outcome["winner"] in {"seasonal_naive", "moving_average", "tweedie"}
    backtests = read_table(spark, lake, "gold", "backtest_forecasts")
    assert backtests.groupBy("model_name", "fold_origin").count().where("count <> 12").isEmpty()
    forecasts = read_table(spark, lake, "gold", "forecasts_bottom")
    assert forecasts.columns == list(contracts.FORECAST_COLUMNS)
    assert contracts.violations(forecasts, contracts.forecast_rules()).isEmpty()
    levels = read_table(spark, lake, "gold", "forecasts_hierarchy").groupBy("level").agg(F.sum("yhat").alias("y")).collect()
    assert len(levels) == 12 and max(r["y"] for r in levels) == pytest.approx(min(r["y"] for r in levels))

    assert jobs.run_final_forecast(spark, lake, cfg, "r3", "tweedie")["status"] == "already_materialized"
    again = jobs.finalize_from_backtests(spark, lake, cfg, "r4")
    assert again["winner"] == outcome["winner"]

    stock = jobs.run_inventory(spark, lake, cfg, "r5")
    assert stock["recommendations"]["rows"] == 4
    assert read_table(spark, lake, "gold", "inventory_levels").where("level < 0").isEmpty()
    advice = read_table(spark, lake, "gold", "inventory_recommendations")
    assert contracts.violations(advice, contracts.recommendation_rules()).isEmpty()

    tables = jobs.evaluate_stored(spark, lake)
    assert tables["accuracy"].count() == 3 and "store_day" in tables["accuracy"].columns


def test_single_model_run(spark, lake, small):
    row = jobs.run_single_model(spark, lake, small, "moving_average", 51).first()
    assert row["fold_origin"] == 51 and row["wrmsse"] >= 0


def test_forecaster_round_trip_and_attribution(spark, lake, small, tmp_path):
    training = read_table(spark, lake, "gold", "training_features").drop("_run_id")
    future = read_table(spark, lake, "gold", "forecast_features").drop("_run_id")
    fitted, predicted = jobs.final_learned(training, future, "poisson", small)
    keys = ["series_id", "horizon"]
    save_forecaster(fitted, str(tmp_path / "m"))
    loaded = load_forecaster(spark, str(tmp_path / "m")).predict(future)
    a = [tuple(r) for r in predicted.select(*keys, "yhat", "q05", "q95").orderBy(*keys).collect()]
    b = [tuple(r) for r in loaded.select(*keys, "yhat", "q05", "q95").orderBy(*keys).collect()]
    assert a == b and len(a) == 12
    assert predicted.where("q05 > q50 OR q50 > q95 OR yhat < 0").isEmpty()
    explained = fitted.explain(future).collect()
    assert len(explained) == 12 and 0.8 <= fitted.factor <= 1.25
    raw = {(r["series_id"], r["horizon"]): r["yhat"] for r in fitted.raw(future).collect()}
    import math

    outputs = sorted(math.exp(r["model_output"]) for r in explained)
    assert outputs == pytest.approx(sorted(raw.values()), rel=1e-6)


def test_categories_are_alphabetical_and_unseen_is_minus_one(spark):
    train = spark.createDataFrame([("b", None), ("a", "x")], "item_id string, target_event_type string")
    codes = {(r["column_name"], r["category"]): r["code"] for r in fit_categories(train).collect()}
    assert codes == {("item_id", "a"): 0.0, ("item_id", "b"): 1.0, ("target_event_type", "__missing__"): 0.0, ("target_event_type", "x"): 1.0}
    scored = encode_categories(spark.createDataFrame([("c", None), ("b", "x")], "item_id string, target_event_type string"), fit_categories(train))
    assert sorted(map(tuple, scored.collect())) == [(-1.0, 0.0), (1.0, 1.0)]


def test_categories_with_one_prefix_are_ranked_in_several_ranges(spark, monkeypatch):
    from demandloom.operators import learned

    sizes, stage = [], learned.staged

    def watched(frame, label):
        written = stage(frame, label)
        sizes.extend(r["count"] for r in written.groupBy("_slice").count().collect())
        return written

    monkeypatch.setattr(learned, "staged", watched)
    names = [f"HOUSEHOLD_1_{k * 7919 % 6000:05d}" for k in range(6000)]
    train = spark.createDataFrame([(n,) for n in names], "item_id string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        codes = {r["category"]: r["code"] for r in fit_categories(train).collect()}
    finally:
        spark.conf.set(coalesce, before)
    assert codes == {n: float(k) for k, n in enumerate(sorted(names))}
    assert len(sizes) > 3 and max(sizes) < 3000


def test_unknown_learner_is_rejected(spark):
    with pytest.raises(ValueError, match="unknown learner"):
        DirectForecaster("nope")._learner()


def test_hurdle_scores_in_a_session_that_observed_a_write_and_is_tagged(spark, panel, small, tmp_path):
    from demandloom.operators.features import build_direct_features

    daily, days = panel
    build_direct_features(daily, days, small).write.parquet(str(tmp_path / "rows"))

    def forecasts(session):
        rows = session.read.parquet(str(tmp_path / "rows"))
        keys = ["series_id", "origin_day", "horizon"]
        found = hurdle_forecast(rows.where("origin_day < 54"), rows.where("origin_day = 54"))
        return [tuple(r) for r in found.orderBy(*keys).select(*keys, "sale_probability", "sale_amount", "yhat").collect()]

    plain = forecasts(spark.newSession())
    used, seen = spark.newSession(), Observation()
    used.range(5).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(str(tmp_path / "observed"))
    assert seen.get == {"rows": 5}
    used.addTag("nightly")
    assert len(plain) == 12 and all(0 <= r[3] <= 1 and r[5] == pytest.approx(r[3] * r[4]) for r in plain)
    found = forecasts(used)
    assert [r[:3] for r in found] == [r[:3] for r in plain]
    assert [r[3:] for r in found] == [pytest.approx(r[3:], rel=1e-6) for r in plain]
