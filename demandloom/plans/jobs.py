"""End-to-end jobs: source files to tables, tables to forecasts, forecasts to stock advice.

Each job reads its inputs from storage and writes its outputs there, so a job
can be repeated alone and a lost executor costs only its running tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.exprs import day_number
from demandloom.operators import accuracy, baselines, contracts, features, hierarchy, inventory, panel, selection
from demandloom.operators.learned import SEARCH_GRID, DirectForecaster, load_forecaster, save_forecaster, search_parameters
from demandloom.plans.stages import Stages
from demandloom.settings import Settings
from demandloom.sources import files, retail
from demandloom.sources.tables import read_table, stamped, table_path, without_lineage, write_table

SOURCE_FILES = tuple(files.REQUIRED_COLUMNS)
LEARNERS = tuple(SEARCH_GRID)


# Ingestion -----------------------------------------------------------------


def ingest_frames(
    spark: SparkSession,
    source_root: str,
    run_id: str,
    file_names: Sequence[str] = SOURCE_FILES,
    required: Mapping[str, Sequence[str]] = files.REQUIRED_COLUMNS,
) -> dict[str, DataFrame]:
    """Typed source frames with lineage, after the source contract has passed."""
    checks = files.source_report(spark, source_root, file_names, required)
    panel.require_valid(
        checks.agg(F.bool_and("valid").alias("valid"), F.collect_list(F.struct(*checks.columns)).alias("checks")),
        "source files",
    )
    # One row per source file.
    digests = {
        r["file"]: r["sha256"] for r in files.combined_digests(files.source_digests(spark, source_root)).collect()
    }
    stamp = datetime.now(UTC).isoformat()
    return {
        name.removesuffix(".csv"): files.read_csv_strict(spark, f"{source_root}/{name}", name).withColumns(
            files.lineage_columns(name, digests[name], stamp, run_id)
        )
        for name in file_names
    }


def run_bronze(
    spark: SparkSession,
    source_root: str,
    lake: str,
    run_id: str,
    file_names: Sequence[str] = SOURCE_FILES,
    required: Mapping[str, Sequence[str]] = files.REQUIRED_COLUMNS,
    fmt: str = "parquet",
) -> dict[str, object]:
    frames = ingest_frames(spark, source_root, run_id, file_names, required)
    return {name: write_table(frame, lake, "bronze", name, fmt=fmt) for name, frame in frames.items()}


def run_silver(spark: SparkSession, lake: str, cfg: Settings, run_id: str, fmt: str = "parquet") -> dict[str, object]:
    """Wide sales to the daily panel; written first, then gated on the stored copy.

    The gate reads the written table, so the panel plan runs once. A panel that
    fails stays unpublished: it is written under a pending name.
    """
    calendar = without_lineage(read_table(spark, lake, "bronze", "calendar", fmt)).withColumns(
        {"date": F.to_date("date"), "day_num": day_number(F.col("d"))}
    )
    prices = without_lineage(read_table(spark, lake, "bronze", "sell_prices", fmt))
    sales = panel.normalize_sales(without_lineage(read_table(spark, lake, "bronze", "sales_train_evaluation", fmt)), cfg)
    daily = stamped(panel.join_daily(sales, calendar, prices), _run_id=run_id)
    write_table(daily, lake, "silver_pending", "sales_daily", fmt=fmt)
    pending = read_table(spark, lake, "silver_pending", "sales_daily", fmt)
    quality = panel.require_valid(panel.validate_panel(pending), "silver panel")
    panel.require_dense(pending)
    return {
        "quality": quality,
        "sales_daily": write_table(
            pending, lake, "silver", "sales_daily", ["state_id", "year"], fmt, ["series_id", "day_num"]
        ),
        "calendar": write_table(calendar, lake, "silver", "calendar", ["year"], fmt),
        "sell_prices": write_table(prices, lake, "silver", "sell_prices", ["store_id"], fmt),
    }


def run_gold(spark: SparkSession, lake: str, cfg: Settings, run_id: str, fmt: str = "parquet") -> dict[str, object]:
    daily = read_table(spark, lake, "silver", "sales_daily", fmt)
    calendar = read_table(spark, lake, "silver", "calendar", fmt)
    prices = read_table(spark, lake, "silver", "sell_prices", fmt)
    tables = {
        "training_features": (features.build_direct_features(daily, calendar, cfg), ["origin_day"], ["series_id", "horizon"]),
        "forecast_features": (features.build_forecast_features(daily, calendar, prices, cfg), [], []),
        "hierarchy": (hierarchy.build_bridge(daily), ["level"], ["series_id"]),
    }
    return {
        name: write_table(stamped(frame, _run_id=run_id), lake, "gold", name, parts, fmt, order)
        for name, (frame, parts, order) in tables.items()
    }


# Forecasting ---------------------------------------------------------------


def learned_fold(
    training: DataFrame, origin: int, kind: str, cfg: Settings, params: Mapping[str, object] | None = None
) -> DataFrame:
    """Fit before a fold origin, calibrate on the newest training origin, forecast the fold."""
    train, evaluation = baselines.split_fold(training, origin)
    fit_rows, validation = baselines.validation_split(train)
    fitted = DirectForecaster(kind, params or {}, cfg.seed).fit(fit_rows, validation)
    predicted = fitted.predict(evaluation)
    return baselines.backtest_contract(stamped(predicted, model_name=kind, fold_origin=origin))


def final_learned(
    training: DataFrame, future: DataFrame, kind: str, cfg: Settings, params: Mapping[str, object] | None = None
) -> tuple[DirectForecaster, DataFrame]:
    """Fit on everything known at the forecast origin; the newest origin calibrates."""
    known = training.where(F.col("origin_day") + F.col("horizon") <= cfg.forecast_origin)
    fit_rows, validation = baselines.validation_split(known)
    fitted = DirectForecaster(kind, params or {}, cfg.seed).fit(fit_rows, validation)
    return fitted, stamped(fitted.predict(future), model_name=kind)


def tuned_parameters(training: DataFrame, models: Sequence[str], cfg: Settings) -> dict[str, dict]:
    """Search once, at the earliest fold; all folds share the result."""
    chosen = [m for m in models if m in LEARNERS]
    if not chosen:
        return {}
    train, _ = baselines.split_fold(training, min(cfg.backtest_origins))
    return {m: search_parameters(train, m, cfg.tune_fraction, cfg.seed)[0] for m in chosen}


def backtest(
    training: DataFrame, models: Sequence[str], cfg: Settings, parameters: Mapping[str, Mapping[str, object]] | None = None
) -> DataFrame:
    """Rolling-origin forecasts of all models in the fixed backtest layout."""
    simple = [m for m in models if m in baselines.BASELINES]
    frames = [baselines.backtest_baselines(training, cfg, simple)] if simple else []
    for model in (m for m in models if m not in baselines.BASELINES):
        for origin in cfg.backtest_origins:
            frames.append(learned_fold(training, origin, model, cfg, (parameters or {}).get(model)))
    return baselines.backtest_contract(*frames)


def run_single_model(
    spark: SparkSession, lake: str, cfg: Settings, model: str, origin: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Accuracy and hierarchy score of one model on one fold."""
    fold = origin or max(cfg.backtest_origins)
    training = read_table(spark, lake, "gold", "training_features", fmt).drop("_run_id")
    daily = read_table(spark, lake, "silver", "sales_daily", fmt)
    if model in baselines.BASELINES:
        forecasts = baselines.backtest_baselines(training, cfg, [model]).where(F.col("fold_origin") == fold)
    else:
        train, _ = baselines.split_fold(training, fold)
        found, _ = search_parameters(train, model, cfg.tune_fraction, cfg.seed)
        forecasts = learned_fold(training, fold, model, cfg, found)
    scores = hierarchy.fold_scores(hierarchy.hierarchical_wrmsse(daily, forecasts, [fold]))
    keys = ["model_name", "fold_origin"]
    return accuracy.point_metrics(forecasts, keys).join(scores, keys)


def _final(training: DataFrame, future: DataFrame, model: str, cfg: Settings, params: Mapping[str, object], lake: str):
    if model in baselines.BASELINES:
        return baselines.final_baseline(training, future, model, cfg)
    forecaster, predicted = final_learned(training, future, model, cfg, params)
    save_forecaster(forecaster, table_path(lake, "models", model))
    return predicted


def _write_forecasts(frame: DataFrame, lake: str, run_id: str, version: str, fmt: str) -> dict[str, object]:
    """Bottom forecasts in contract layout, then their sums at all levels from the stored copy."""
    bottom = stamped(frame, run_id=run_id, model_version=version).select(*contracts.FORECAST_COLUMNS)
    written = write_table(bottom, lake, "gold", "forecasts_bottom", fmt=fmt)
    stored = read_table(frame.sparkSession, lake, "gold", "forecasts_bottom", fmt)
    keys = ["run_id", "model_name", "origin_date", "target_date", "horizon"]
    summed = hierarchy.hierarchy_rollup(stored, ["yhat", "q05", "q50", "q95"], keys)
    return {
        "bottom": written,
        "hierarchy": write_table(summed, lake, "gold", "forecasts_hierarchy", ["level"], fmt, ["node_id"]),
    }


def run_forecasting(
    spark: SparkSession,
    lake: str,
    cfg: Settings,
    run_id: str,
    models: Sequence[str] = (*baselines.BASELINES, "tweedie"),
    fmt: str = "parquet",
) -> dict[str, object]:
    """Tune, backtest, score, choose a winner and forecast from the final origin."""
    training = read_table(spark, lake, "gold", "training_features", fmt).drop("_run_id")
    future = read_table(spark, lake, "gold", "forecast_features", fmt).drop("_run_id")
    daily = read_table(spark, lake, "silver", "sales_daily", fmt)
    tuned = tuned_parameters(training, models, cfg)
    write_table(backtest(training, models, cfg, tuned), lake, "gold", "backtest_forecasts", fmt=fmt)
    backtests = read_table(spark, lake, "gold", "backtest_forecasts", fmt)
    details = hierarchy.hierarchical_wrmsse(daily, backtests, cfg.backtest_origins)
    write_table(details, lake, "gold", "wrmsse_details", ["model_name", "fold_origin"], fmt, ["node_id"])
    stored_details = read_table(spark, lake, "gold", "wrmsse_details", fmt)
    write_table(selection.model_summary(backtests, stored_details), lake, "gold", "model_metrics", fmt=fmt)
    return _finish(spark, lake, cfg, run_id, training, future, tuned, fmt)


def _finish(spark, lake, cfg, run_id, training, future, tuned, fmt) -> dict[str, object]:
    metrics = read_table(spark, lake, "gold", "model_metrics", fmt)
    winner = selection.select_winner(metrics, cfg.guardrails).first()["model_name"]
    final = _final(training, future, winner, cfg, tuned.get(winner, {}), lake)
    return {"run_id": run_id, "winner": winner, "forecasts": _write_forecasts(final, lake, run_id, run_id, fmt)}


def finalize_from_backtests(spark: SparkSession, lake: str, cfg: Settings, run_id: str, fmt: str = "parquet") -> dict[str, object]:
    """Choose again from the stored metrics, refit without tuned parameters, rewrite the forecasts."""
    training = read_table(spark, lake, "gold", "training_features", fmt).drop("_run_id")
    future = read_table(spark, lake, "gold", "forecast_features", fmt).drop("_run_id")
    return _finish(spark, lake, cfg, run_id, training, future, {}, fmt)


def run_final_forecast(
    spark: SparkSession, lake: str, cfg: Settings, run_id: str, model: str, fmt: str = "parquet"
) -> dict[str, object]:
    """Score the forecast rows with a stored model, unless forecasts already exist."""
    try:
        existing = read_table(spark, lake, "gold", "forecasts_bottom", fmt)
        if not existing.isEmpty():
            return {"run_id": run_id, "status": "already_materialized"}
    except Exception as problem:  # the path does not exist yet
        if "PATH_NOT_FOUND" not in str(problem):
            raise
    future = read_table(spark, lake, "gold", "forecast_features", fmt).drop("_run_id")
    forecaster = load_forecaster(spark, table_path(lake, "models", model))
    scored = stamped(forecaster.predict(future), model_name=model)
    return {"run_id": run_id, "status": "scored_stored_model", "forecasts": _write_forecasts(scored, lake, run_id, model, fmt)}


def run_inventory(spark: SparkSession, lake: str, cfg: Settings, run_id: str, fmt: str = "parquet") -> dict[str, object]:
    """Order-up-to levels of the winner's newest fold and recommended orders."""
    backtests = read_table(spark, lake, "gold", "backtest_forecasts", fmt)
    if "unit_price" not in backtests.columns:
        backtests = inventory.with_unit_price(backtests, read_table(spark, lake, "gold", "training_features", fmt))
    forecasts = read_table(spark, lake, "gold", "forecasts_bottom", fmt)
    winner = forecasts.select("model_name").first()["model_name"]
    used = backtests.where(F.col("model_name") == winner)
    blocks = inventory.residual_blocks(used, cfg.horizon)
    levels = inventory.review_levels(inventory.latest_fold(used), blocks, [cfg.policy], cfg.horizon, cfg.seed)
    stored = write_table(stamped(levels, run_id=run_id), lake, "gold", "inventory_levels", fmt=fmt)
    advice = inventory.recommendations(forecasts, blocks, cfg.policy, cfg.seed)
    written = write_table(
        contracts.require_exact_columns(stamped(advice, run_id=run_id), contracts.RECOMMENDATION_COLUMNS),
        lake, "gold", "inventory_recommendations", fmt=fmt,
    )
    return {"run_id": run_id, "levels": stored, "recommendations": written}


def evaluate_stored(spark: SparkSession, lake: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Accuracy tables from stored outputs; nothing is trained."""
    backtests = read_table(spark, lake, "gold", "backtest_forecasts", fmt)
    summary = read_table(spark, lake, "gold", "model_metrics", fmt)
    details = read_table(spark, lake, "gold", "wrmsse_details", fmt)
    return {"accuracy": selection.accuracy_table(summary, backtests, hierarchy.bottom_rmsse(details))}


# Source files made from the star-schema tables ------------------------------


EXPORT_CONTRACT: dict[str, Sequence[str]] = {
    "sales_train_evaluation.csv": (*files.SALES_IDENTIFIERS, "d_1", f"d_{retail.LAST_DAY}"),
    "sell_prices.csv": files.REQUIRED_COLUMNS["sell_prices.csv"],
    "calendar.csv": files.REQUIRED_COLUMNS["calendar.csv"],
}


def csv_sources(stages: Stages) -> str:
    """Folder with the panel as CSV sources (each a folder of part files)."""

    def export(root: str) -> None:
        frames = {
            "sales_train_evaluation.csv": stages.wide_table(),
            "sell_prices.csv": stages.prices(),
            "calendar.csv": stages.calendar().drop("day_num"),
        }
        for name, frame in frames.items():
            frame.write.option("header", True).csv(f"{root}/{name}")

    return stages.csv_folder(export)


def csv_roundtrip_audit(stages: Stages) -> DataFrame:
    frames = ingest_frames(stages.spark, csv_sources(stages), "roundtrip", list(EXPORT_CONTRACT), EXPORT_CONTRACT)
    return files.lineage_audit(frames)


def csv_source_report(stages: Stages) -> DataFrame:
    checks = files.source_report(stages.spark, csv_sources(stages), list(EXPORT_CONTRACT), EXPORT_CONTRACT)
    return checks.select("file", "exists", "columns", F.size("missing_required_columns").alias("missing"), "valid")


def csv_wide_structure(stages: Stages) -> DataFrame:
    name = "sales_train_evaluation.csv"
    return files.wide_structure(files.read_csv_strict(stages.spark, f"{csv_sources(stages)}/{name}", name))
