"""Post-processing of point forecasts: grids, group scales and blends.

The absolute error of ``scale * forecast`` is piecewise linear in the scale.
Each row is therefore assigned once to the cell between two grid scales where
its error changes sign, and only the sums per cell are kept. A grid of any size
costs one pass over the rows instead of one copy of the rows per grid point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import clamp, floored

# Grids and priors of the search.
THRESHOLDS = tuple(i * 0.1 for i in range(16))
SCALES = tuple(0.6 + i * 0.025 for i in range(25))
WIDE_SCALES = tuple(0.5 + i * 0.025 for i in range(61))
WEIGHTS = tuple(i * 0.1 for i in range(11))
BIAS_LIMIT = 0.05
SEASONAL_LAGS = (28, 35, 42, 49, 56)
GROUP_PRIORS = {
    "series_calibration": (("series_id",), 28.0),
    "series_horizon_cal": (("series_id", "horizon"), 10.0),
    "store_item_cal": (("store_id", "item_id"), 28.0),
    "store_dept_cal": (("store_id", "dept_id"), 100.0),
    "dept_horizon_cal": (("dept_id", "horizon"), 100.0),
}


def _count_true(conditions: Sequence[Column]) -> Column:
    total = F.lit(0)
    for condition in conditions:
        total = total + condition.cast("int")
    return total


def _cell_sums(frame: DataFrame, keys: Sequence[str], scales: Sequence[float], thresholds: Sequence[float]) -> DataFrame:
    """Sums of actual and forecast per key, scale cell and threshold cell.

    ``scale_cell`` counts the scales at which the row is still under-forecast;
    ``kept`` counts the thresholds the forecast survives.
    """
    y, p = F.col("target"), F.col("yhat")
    return (
        frame.withColumns(
            {
                "scale_cell": _count_true([p * s < y for s in scales]),
                "kept": _count_true([p >= t for t in thresholds]),
            }
        )
        .groupBy(*keys, "scale_cell", "kept")
        .agg(F.sum(y).alias("y"), F.sum(p).alias("p"), F.sum(F.abs(y)).alias("size"))
    )


def _grid_scores(cells: DataFrame, keys: Sequence[str], scales: Sequence[float], thresholds: Sequence[float]) -> DataFrame:
    """WAPE and bias of every grid point; the cells are a fixed-size table per key."""
    kept = F.col("kept") > F.col("i")
    under = F.col("scale_cell") > F.col("j")
    scaled = F.col("scale") * F.col("p")
    miss = F.when(~kept, F.col("size")).when(under, F.col("y") - scaled).otherwise(scaled - F.col("y"))
    signed = F.when(kept, scaled).otherwise(F.lit(0.0)) - F.col("y")
    size = floored(F.sum("size"))
    points = cells.select(
        *cells.columns, F.posexplode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("i", "threshold")
    ).select("*", F.posexplode(F.array(*[F.lit(float(s)) for s in scales])).alias("j", "scale"))
    return (
        points.groupBy(*keys, "threshold", "scale")
        .agg((F.sum(miss) / size).alias("wape"), (F.sum(signed) / size).alias("bias"))
    )


def _first_best(scores: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Lowest WAPE per key; equal values (to 10 places) go to the earliest grid point."""
    ranked = F.struct(F.round("wape", 10).alias("_w"), *order)
    wanted = [c for c in scores.columns if c not in keys]
    best = scores.groupBy(*keys).agg(F.min_by(F.struct(*wanted), ranked).alias("_best"))
    return best.where(F.col("_best").isNotNull()).select(*keys, "_best.*")


def threshold_scale_search(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Best (threshold, scale): forecasts below the threshold become 0, the rest are scaled."""
    scores = _grid_scores(_cell_sums(frame, keys, SCALES, THRESHOLDS), keys, SCALES, THRESHOLDS)
    return _first_best(scores, keys, ["threshold", "scale"])


def unbiased_scale_search(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Best scale whose absolute bias stays within the limit; keys without one give no row."""
    scores = _grid_scores(_cell_sums(frame, keys, WIDE_SCALES, [float("-inf")]), keys, WIDE_SCALES, [float("-inf")])
    within = scores.where(F.abs(F.round("bias", 10)) <= BIAS_LIMIT).drop("threshold")
    return _first_best(within, keys, ["scale"])


def apply_threshold_scale(frame: DataFrame, best: DataFrame) -> DataFrame:
    """Apply a one-row search result."""
    chosen = F.broadcast(best.select("threshold", "scale"))
    adjusted = F.when(F.col("yhat") < F.col("threshold"), 0.0).otherwise(F.col("yhat")) * F.col("scale")
    return frame.crossJoin(chosen).withColumn("yhat", adjusted).drop("threshold", "scale")


def group_scales(calibration: DataFrame, columns: Sequence[str], prior_units: float) -> DataFrame:
    """Shrunken ratio of actual to forecast totals per group."""
    ratio = (F.sum("target") + prior_units) / (F.sum("yhat") + prior_units)
    return calibration.groupBy(*columns).agg(clamp(ratio, 0.5, 2.0).alias("group_scale"))


def apply_group_scale(
    calibration: DataFrame, scoring: DataFrame, columns: Sequence[str], prior_units: float
) -> DataFrame:
    """Scale forecasts by their group's ratio; groups never calibrated keep their forecast."""
    scales = group_scales(calibration, columns, prior_units)
    return (
        scoring.join(scales, list(columns), "left")
        .withColumn("yhat", F.col("yhat") * F.coalesce("group_scale", F.lit(1.0)))
        .drop("group_scale")
    )


def seasonal_mean(lags: Sequence[int] = SEASONAL_LAGS) -> Column:
    """Mean of the known target lags; null when none is known."""
    known = [F.col(f"target_lag_{k}") for k in lags]
    count = _count_true([c.isNotNull() for c in known])
    total = F.lit(0.0)
    for c in known:
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(count > 0, total / count)


def blend_search(frame: DataFrame, model: str, seasonal: str) -> DataFrame:
    """Best weight of the model against the seasonal mean, each weight with its own unbiased scale."""
    shares = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    blended = frame.select("target", model, seasonal, F.explode(shares).alias("weight")).select(
        "weight",
        "target",
        (F.col("weight") * F.col(model) + (F.lit(1.0) - F.col("weight")) * F.col(seasonal)).alias("yhat"),
    )
    per_weight = unbiased_scale_search(blended, ["weight"])
    return _first_best(per_weight, [], ["weight"])
