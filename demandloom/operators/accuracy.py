"""Point, interval and quantile accuracy at several granularities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import demand_regime, floored, forecast_week, pinball, rate

POINT = ("mae", "rmse", "wape", "bias")
INTERVAL = (
    "coverage", "mean_interval_width", "pinball_q05", "pinball_q50", "pinball_q95", "mean_pinball_loss",
)

# The grains at which errors are reported; the first is the raw rows.
GRANULARITIES = {
    "sku_store_day": (),
    "sku_store_28d": ("series_id",),
    "store_day": ("store_id", "target_date"),
    "store_category_day": ("store_id", "cat_id", "target_date"),
    "total_day": ("target_date",),
    "sku_store_week": ("series_id", "forecast_week"),
    "store_category_week": ("store_id", "cat_id", "forecast_week"),
}


def require_columns(frame: DataFrame, needed: Sequence[str], what: str) -> None:
    """Fail before any job runs when columns are absent."""
    absent = sorted(set(needed) - set(frame.columns))
    if absent:
        raise ValueError(f"{what} are missing columns: {absent}")


def _point_aggregates() -> list[Column]:
    error = F.col("yhat") - F.col("target")
    size = floored(F.sum(F.abs("target")))
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.sum(F.abs(error)) / size).alias("wape"),
        (F.sum(error) / size).alias("bias"),
    ]


def _interval_aggregates() -> list[Column]:
    y = F.col("target")
    losses = {q: F.avg(pinball(y, F.col(q), level)) for q, level in (("q05", 0.05), ("q50", 0.5), ("q95", 0.95))}
    return [
        rate((y >= F.col("q05")) & (y <= F.col("q95"))).alias("coverage"),
        F.avg(F.col("q95") - F.col("q05")).alias("mean_interval_width"),
        *[loss.alias(f"pinball_{q}") for q, loss in losses.items()],
        ((losses["q05"] + losses["q50"] + losses["q95"]) / 3).alias("mean_pinball_loss"),
    ]


def point_metrics(frame: DataFrame, keys: Sequence[str], intervals: bool = True) -> DataFrame:
    """Accuracy per key in one aggregation; no keys gives one row."""
    needed = [*keys, "target", "yhat", *(("q05", "q50", "q95") if intervals else ())]
    require_columns(frame, needed, "forecasts")
    return frame.groupBy(*keys).agg(*_point_aggregates(), *(_interval_aggregates() if intervals else ()))


def backtest_summary(backtests: DataFrame) -> DataFrame:
    """Unweighted mean over folds of the per-fold accuracy of each model."""
    require_columns(
        backtests, ("model_name", "fold_origin", "target", "yhat", "q05", "q50", "q95"), "backtests"
    )
    folds = point_metrics(backtests, ["model_name", "fold_origin"])
    return folds.groupBy("model_name").agg(*[F.avg(m).alias(m) for m in (*POINT, *INTERVAL)])


def wape_by_granularity(backtests: DataFrame) -> DataFrame:
    """Errors after summing targets and forecasts to each grain inside a fold, then averaged over folds."""
    require_columns(
        backtests,
        ("model_name", "fold_origin", "series_id", "store_id", "cat_id", "target_date", "horizon", "target", "yhat"),
        "backtests",
    )
    fold = ["model_name", "fold_origin"]
    weekly = backtests.withColumn("forecast_week", forecast_week(F.col("horizon")))
    coarse = {name: grain for name, grain in GRANULARITIES.items() if grain}
    used = ["series_id", "store_id", "cat_id", "target_date", "forecast_week"]
    columns = [F.col(c) for c in [*fold, *used]]
    summed = weekly.groupingSets([[F.col(c) for c in [*fold, *grain]] for grain in coarse.values()], *columns).agg(
        F.grouping_id(*columns).alias("_set"), F.sum("target").alias("target"), F.sum("yhat").alias("yhat")
    )
    label = F.lit(None).cast("string")
    for name, grain in coarse.items():
        mask = sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in grain)
        label = F.when(F.col("_set") == mask, F.lit(name)).otherwise(label)
    rows = summed.select(*fold, label.alias("granularity"), "target", "yhat").unionByName(
        backtests.select(*fold, F.lit("sku_store_day").alias("granularity"), "target", "yhat")
    )
    return (
        point_metrics(rows, [*fold, "granularity"], intervals=False)
        .groupBy("model_name", "granularity")
        .agg(*[F.avg(m).alias(m) for m in POINT])
    )


def wape_pivot(granular: DataFrame) -> DataFrame:
    """One row per model, one WAPE column per grain."""
    return granular.groupBy("model_name").pivot("granularity", list(GRANULARITIES)).agg(F.first("wape"))


def horizon_errors(backtests: DataFrame) -> DataFrame:
    """Error by forecast horizon per model."""
    error = F.col("yhat") - F.col("target")
    demand = F.sum("target")
    return backtests.groupBy("model_name", "horizon").agg(
        demand.alias("demand"),
        F.sum(F.abs(error)).alias("abs_error"),
        F.avg(F.abs(error)).alias("mae"),
        F.sum(error).alias("bias_units"),
        (F.sum(F.abs(error)) / floored(demand)).alias("wape"),
        (F.sum(error) / floored(demand)).alias("bias"),
    )


def _error_sums() -> list[Column]:
    error = F.col("yhat") - F.col("target")
    return [
        F.sum("target").alias("demand"),
        F.sum(F.abs(error)).alias("abs_error"),
        F.sum(error).alias("signed_error"),
    ]


def _with_rates(frame: DataFrame) -> DataFrame:
    size = floored(F.col("demand"))
    return frame.withColumns({"wape": F.col("abs_error") / size, "bias": F.col("signed_error") / size})


def regime_errors(backtests: DataFrame, reference_model: str) -> DataFrame:
    """Error by demand regime; regimes come from the evaluated demand of one model's rows."""
    regimes = (
        backtests.where(F.col("model_name") == reference_model)
        .groupBy("series_id")
        .agg(demand_regime(rate(F.col("target") == 0)).alias("demand_regime"))
    )
    by_series = backtests.groupBy("model_name", "series_id").agg(F.count(F.lit(1)).alias("n"), *_error_sums())
    return _with_rates(
        by_series.join(regimes, "series_id", "left")
        .groupBy("model_name", "demand_regime")
        .agg(
            F.sum("n").alias("row_count"),
            F.count(F.lit(1)).alias("series"),
            F.sum("demand").alias("demand"),
            F.sum("abs_error").alias("abs_error"),
            F.sum("signed_error").alias("signed_error"),
        )
    )


def segment_errors(backtests: DataFrame) -> DataFrame:
    """Error by state, category and department from one aggregation over series."""
    by_series = backtests.groupBy("model_name", "series_id", "state_id", "cat_id", "dept_id").agg(*_error_sums())
    segments = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("segment")) for c in ("state_id", "cat_id", "dept_id")]
    )
    return _with_rates(
        by_series.select("model_name", "demand", "abs_error", "signed_error", F.inline(segments))
        .groupBy("model_name", "dimension", "segment")
        .agg(
            F.count(F.lit(1)).alias("series"),
            F.sum("demand").alias("demand"),
            F.sum("abs_error").alias("abs_error"),
            F.sum("signed_error").alias("signed_error"),
        )
    )


def review_flags(granular: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Development warning per model at item and store grain."""

    def verdict(name: str) -> Column:
        return F.when(F.col(name) > threshold, "needs improvement").otherwise("passes review")

    wide = wape_pivot(granular)
    return wide.select(
        "model_name",
        F.col("sku_store_day").alias("sku_store_day_wape"),
        F.col("store_day").alias("store_day_wape"),
        F.lit(threshold).alias("review_threshold"),
        verdict("sku_store_day").alias("item_status"),
        verdict("store_day").alias("store_planning_status"),
    )


def zero_demand_share(backtests: DataFrame) -> DataFrame:
    return backtests.groupBy("model_name").agg(rate(F.col("target") == 0).alias("zero_share"))
