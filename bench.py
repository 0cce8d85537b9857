"""Headline queries, timed; prints one JSON line.

Every query is executed in full into a no-op sink. Shared stage tables are built
first and reported under their own names, so no query hides another's cost.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from demandloom.plans.reports import QUERIES  # noqa: E402
from demandloom.plans.stages import Stages  # noqa: E402

HEADLINE = (
    "daily_sales", "demand_panel", "weekly_prices", "panel_quality", "duplicate_keys", "demand_profile",
    "intermittency_regimes", "retail_mix", "origin_features", "target_lags", "direct_training_features",
    "forecast_features", "leakage_audit", "hierarchy_rollup", "node_scales", "hierarchical_wrmsse",
    "residual_calibration", "baseline_backtest", "backtest_summary", "wape_by_granularity", "model_summary",
    "threshold_scale_grid", "unbiased_scale_grid", "group_scale", "order_up_to_bootstrap", "recommendations", "attribution_global", "attribution_segment", "attribution_summary",
    "final_forecast_hierarchy", "tweedie_forecast", "gbt_forecast", "learned_final_forecast", "glm_attribution",
    "future_blind_audit", "lake_round_trip",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="spark-bench-"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.range(1000).selectExpr("sum(id)").collect()
    stages = Stages(spark, sf_dir)
    timings: dict[str, float] = {}
    tables = {
        "stage_sales": stages.sales_table,
        "stage_daily": stages.daily_table,
        "stage_prices": stages.price_table,
        "stage_training": stages.training,
        "stage_future": stages.future,
        "stage_backtests": stages.backtests,
        "stage_details": stages.details,
        "stage_summary": stages.summary,
        "stage_forecasts": stages.forecasts,
    }
    for name, build in tables.items():
        began = time.perf_counter()
        build()
        timings[name] = round(time.perf_counter() - began, 3)
    for name in HEADLINE:
        began = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - began, 3)
    # The same panel with items by brand and type: six times the series, so that work per panel row can be compared.
    grown = Stages(spark, sf_dir, item_key="brand_type")
    panel_rows = {"brand": stages.daily_table().count()}
    for name, build in {"grown_daily": grown.daily_table, "grown_training": grown.training}.items():
        began = time.perf_counter()
        build()
        timings[name] = round(time.perf_counter() - began, 3)
    panel_rows["brand_type"] = grown.daily_table().count()
    per_million = {
        key: round((timings[daily] + timings[training]) / panel_rows[key] * 1e6, 3)
        for key, daily, training in (("brand", "stage_daily", "stage_training"), ("brand_type", "grown_daily", "grown_training"))
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "panel_rows": panel_rows,
                "seconds_per_million_panel_rows": per_million,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
