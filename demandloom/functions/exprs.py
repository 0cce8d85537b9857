"""Small column expressions; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-12
SNAP_STATES = ("CA", "TX", "WI")

# Display names of the known forecasters.
MODEL_LABELS = {
    "lightgbm": "LightGBM",
    "xgboost": "XGBoost",
    "nhits": "N-HiTS",
    "moving_average": "Moving Average",
    "seasonal_naive": "Seasonal Naive",
}


def non_negative(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def floored(value: Column) -> Column:
    """Denominator that can never be zero."""
    return F.greatest(value, F.lit(TINY))


def guarded_ratio(numerator: Column, base: Column) -> Column:
    """Ratio where the base is a positive number, 0 elsewhere; a null numerator stays null."""
    return F.when(base > 0, numerator / base).otherwise(F.lit(0.0))


def rate(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def pinball(actual: Column, predicted: Column, level: float) -> Column:
    """Quantile loss of one row; positive error means the quantile was too low."""
    if not 0 < level < 1:
        raise ValueError("quantile must be strictly between zero and one")
    miss = actual - predicted
    return F.greatest(F.lit(level) * miss, F.lit(level - 1) * miss)


def forecast_week(horizon: Column) -> Column:
    return ((horizon - 1) / 7).cast("int") + 1


def day_number(label: Column) -> Column:
    """``d_17`` -> 17; anything else -> null instead of an ANSI cast error."""
    return F.regexp_extract(label, r"^d_(\d+)$", 1).try_cast("int")


def model_label(name: Column) -> Column:
    known = F.create_map(*[F.lit(part) for pair in MODEL_LABELS.items() for part in pair])
    return F.coalesce(F.try_element_at(known, name), F.initcap(F.translate(name, "_", " ")))


def demand_regime(zero_rate: Column) -> Column:
    return (
        F.when(zero_rate <= 0.50, "dense")
        .when(zero_rate <= 0.80, "intermittent")
        .when(zero_rate <= 0.95, "sparse")
        .otherwise("very_sparse")
    )


def own_snap(state: Column, prefix: str = "snap_") -> Column:
    """The programme flag of the row's own state, 0 for other states."""
    flags = [F.when(state == name, F.col(f"{prefix}{name}")) for name in SNAP_STATES]
    return F.coalesce(*flags, F.lit(0))


def text_hash(*parts: Column) -> Column:
    """Hex digest of the parts; the same in every engine, so samples can be checked anywhere."""
    return F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))


def hash_number(digest: Column) -> Column:
    """First 32 bits of a hex digest as a non-negative integer."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
