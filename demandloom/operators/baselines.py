"""Baseline forecasters, residual calibration and the rolling-origin backtest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import clamp, non_negative
from demandloom.operators.quantiles import exact_quantiles, exact_quantiles_by_weight
from demandloom.settings import SERIES_KEYS, Settings

CONTRACT = (
    *SERIES_KEYS, "origin_day", "fold_origin", "origin_date", "day_num", "horizon", "target_date",
    "model_name", "target", "yhat", "q05", "q50", "q95", "unit_price",
)
BASELINES = ("seasonal_naive", "moving_average")
FORECAST_KEYS = ("model_name", "fold_origin")
OFFSETS = {"o05": 0.05, "o50": 0.5, "o95": 0.95}


def seasonal_naive() -> Column:
    """The latest known observation that shares the target's position in the week."""
    week = F.array(*[F.col(f"lag_{k}") for k in range(1, 8)])
    back = 7 - F.pmod(F.col("horizon") - 1, F.lit(7))
    return non_negative(F.coalesce(F.element_at(week, back.cast("int")), F.lit(0.0)))


def moving_average(window: int = 28) -> Column:
    return non_negative(F.coalesce(F.col(f"rolling_mean_{window}"), F.lit(0.0)))


def baseline_points(features: DataFrame, models: Sequence[str] = BASELINES) -> DataFrame:
    """One row per feature row and baseline, with its point forecast."""
    points = {"seasonal_naive": seasonal_naive(), "moving_average": moving_average()}
    variants = [F.struct(F.lit(m).alias("model_name"), points[m].alias("yhat")) for m in models]
    has_target = ["target"] if "target" in features.columns else []
    return features.select(
        *SERIES_KEYS,
        "origin_day",
        "origin_date",
        "horizon",
        "target_date",
        *has_target,
        F.col("target_sell_price").alias("unit_price"),
        F.inline(F.array(*variants)),
    )


def training_rows(frame: DataFrame, folds: Sequence[int]) -> DataFrame:
    """Repeat each row for every fold whose origin comes after its target was known."""
    known_by = F.col("origin_day") + F.col("horizon")
    usable = [F.when((F.col("origin_day") < o) & (known_by <= o), F.lit(o)) for o in folds]
    return frame.withColumn("fold_origin", F.explode(F.array(*usable))).where(F.col("fold_origin").isNotNull())


def evaluation_rows(frame: DataFrame, folds: Sequence[int]) -> DataFrame:
    return frame.where(F.col("origin_day").isin(list(folds))).withColumn("fold_origin", F.col("origin_day"))


def split_fold(features: DataFrame, origin: int) -> tuple[DataFrame, DataFrame]:
    """Rows known at the origin, and the rows to be forecast from it."""
    train = features.where((F.col("origin_day") < origin) & (F.col("origin_day") + F.col("horizon") <= origin))
    evaluation = features.where(F.col("origin_day") == origin)
    if train.isEmpty() or evaluation.isEmpty():
        raise ValueError(f"fold {origin} has no training or evaluation rows")
    return train, evaluation


def validation_split(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fit rows and validation rows: the newest origin validates, all rows serve both if it is the only one."""
    span = train.agg(F.min("origin_day").alias("low"), F.max("origin_day").alias("high")).first()
    if span is None or span["high"] is None:
        raise ValueError("no training rows")
    validation = train.where(F.col("origin_day") == span["high"])
    if span["low"] == span["high"]:
        return train, validation
    return train.where(F.col("origin_day") < span["high"]), validation


def residual_tally(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows of every residual per key and horizon; what folds and fallbacks need is summed from this."""
    residual = (F.col("target") - F.col("yhat")).alias("residual")
    return points.select(*keys, "horizon", residual).groupBy(*keys, "horizon", "residual").agg(F.count(F.lit(1)).alias("rows"))


def fold_calibration(points: DataFrame, folds: Sequence[int]) -> DataFrame:
    """Calibration of every model and fold, each from the rows known at the fold's origin.

    Folds are columns that count rows, not copies of rows; one ordered pass per model and horizon serves all of them.
    """
    known_by = F.col("origin_day") + F.col("horizon")
    known = {f: ((F.col("origin_day") < f) & (known_by <= f)).cast("int") for f in folds}
    newest = max(folds)
    usable = points.where((F.col("origin_day") < newest) & (known_by <= newest))
    # Horizon 0 stands for all horizons; every row counts once in each.
    rows = usable.select(
        "model_name",
        (F.col("target") - F.col("yhat")).alias("residual"),
        *[c.alias(f"known_{f}") for f, c in known.items()],
        F.explode(F.array(F.col("horizon"), F.lit(0))).alias("horizon"),
    )
    weights = {f: f"known_{f}" for f in folds}
    offsets = exact_quantiles_by_weight(rows, ["model_name", "horizon"], "residual", OFFSETS, weights, "fold_origin")
    return offsets.select(*FORECAST_KEYS, F.when(F.col("horizon") != 0, F.col("horizon")).alias("horizon"), *OFFSETS)


def fit_calibration(residuals: DataFrame, by: Sequence[str] = FORECAST_KEYS) -> DataFrame:
    """Residual quantiles per horizon, and over all horizons (horizon null) as fallback.

    Takes a residual tally, or points with target and yhat.
    """
    by = list(by)
    tally = residuals if "rows" in residuals.columns else residual_tally(residuals, by)
    # Horizon 0 stands for all horizons; every row counts once in each.
    both = tally.select(*by, F.explode(F.array(F.col("horizon"), F.lit(0))).alias("horizon"), "residual", "rows")
    offsets = exact_quantiles(both, [*by, "horizon"], "residual", OFFSETS, weight="rows")
    return offsets.withColumn("horizon", F.when(F.col("horizon") != 0, F.col("horizon")))


def apply_calibration(points: DataFrame, calibration: DataFrame, by: Sequence[str] = FORECAST_KEYS) -> DataFrame:
    """Add ordered, non-negative q05/q50/q95; horizons never seen use the overall offsets.

    The calibration holds (horizons + 1) rows per model and fold, whatever the
    number of series, which bounds the broadcast.
    """
    by = list(by)
    names = ("o05", "o50", "o95")
    seen = calibration.where(F.col("horizon").isNotNull())
    overall = calibration.where(F.col("horizon").isNull()).select(*by, *[F.col(n).alias(f"f_{n}") for n in names])
    joined = points.join(F.broadcast(seen), [*by, "horizon"], "left")
    joined = joined.join(F.broadcast(overall), by, "left") if by else joined.crossJoin(F.broadcast(overall))
    shifted = [
        non_negative(F.col("yhat") + F.coalesce(F.col(n), F.col(f"f_{n}"), F.lit(0.0))) for n in names
    ]
    ordered = F.sort_array(F.array(*shifted))
    return joined.select(
        *points.columns, *[F.get(ordered, F.lit(i)).alias(q) for i, q in enumerate(("q05", "q50", "q95"))]
    )


def backtest_contract(*frames: DataFrame) -> DataFrame:
    """Stack forecasts of differing shape into the fixed backtest layout.

    The price is the first known of the planned and the panel price, else 0;
    the origin date always follows from target date and horizon.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    sources = [F.col(c) for c in ("unit_price", "target_sell_price", "sell_price") if c in stacked.columns]
    return stacked.withColumns(
        {
            "target_date": F.to_date("target_date"),
            "origin_date": F.date_sub(F.to_date("target_date"), F.col("horizon")),
            "day_num": F.col("origin_day") + F.col("horizon"),
            "unit_price": F.coalesce(*sources, F.lit(0.0)),
        }
    ).select(*CONTRACT)


def backtest_baselines(features: DataFrame, cfg: Settings, models: Sequence[str] = BASELINES) -> DataFrame:
    """All baselines over all folds in one plan: the fold is a column, not a loop."""
    points = baseline_points(features, models)
    calibration = fold_calibration(points, cfg.backtest_origins)
    evaluated = evaluation_rows(points, cfg.backtest_origins)
    return backtest_contract(apply_calibration(evaluated, calibration))


def final_baseline(features: DataFrame, future: DataFrame, model: str, cfg: Settings) -> DataFrame:
    """Calibrate one baseline on everything known at the forecast origin and forecast from it."""
    origin = cfg.forecast_origin
    known = baseline_points(features, [model]).where(F.col("origin_day") + F.col("horizon") <= origin)
    calibration = fit_calibration(known.withColumn("fold_origin", F.lit(origin)))
    points = baseline_points(future, [model]).withColumn("fold_origin", F.lit(origin))
    return apply_calibration(points, calibration)


def level_factor(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bounded ratio of actual to predicted totals; 1 where nothing was predicted."""
    predicted = F.sum("yhat")
    factor = F.when(predicted > 0, clamp(F.sum("target") / predicted, 0.8, 1.25)).otherwise(F.lit(1.0))
    return frame.groupBy(*keys).agg(factor.alias("level_factor"))
