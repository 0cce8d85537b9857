"""Additive attributions: construction from a linear model and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import TINY, rate

PREFIX = "shap_"

# Name patterns of the feature families, tried in this order.
CALENDAR_NAMES = ("origin_day", "horizon")
CALENDAR_PREFIXES = ("target_wday", "target_month", "target_event", "target_snap")
HISTORY_PREFIXES = ("target_lag_", "lag_", "rolling_", "nonzero_", "days_since_", "short_long_")
SERIES_PATTERN = r"^([^_]+)_.+_([A-Z]{2}_\d+)$"


def linear_attribution(
    frame: DataFrame, coefficients: Mapping[str, float], intercept: float = 0.0
) -> DataFrame:
    """Exact additive attribution of a linear predictor around the mean row.

    ``shap_f = b_f * (x_f - mean(x_f))``; the base value is the prediction at the
    mean row, so base plus attributions is the model output on its link scale.
    Missing values count as 0, as in training.
    """
    names = list(coefficients)
    filled = frame.select(
        "series_id", "horizon", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names if c != "horizon"]
    )
    # One row of means.
    means = filled.agg(*[F.avg(c).alias(f"_mean_{c}") for c in names])
    parts = {c: F.lit(coefficients[c]) * (F.col(c) - F.col(f"_mean_{c}")) for c in names}
    base = F.lit(intercept)
    for c in names:
        base = base + F.lit(coefficients[c]) * F.col(f"_mean_{c}")
    output = base
    for part in parts.values():
        output = output + part
    return filled.crossJoin(F.broadcast(means)).select(
        "series_id",
        "horizon",
        *[part.alias(f"{PREFIX}{c}") for c, part in parts.items()],
        *[F.col(c).cast("double").alias(f"feature_{c}") for c in names],
        base.alias("base_value"),
        output.alias("model_output"),
    )


def attributed_features(frame: DataFrame) -> list[str]:
    absent = [c for c in ("series_id", "horizon") if c not in frame.columns]
    if absent:
        raise ValueError(f"attributions are missing columns: {absent}")
    features = [c.removeprefix(PREFIX) for c in frame.columns if c.startswith(PREFIX)]
    if not features:
        raise ValueError("attributions contain no shap_<feature> columns")
    return features


def feature_family(feature: Column) -> Column:
    def starts(prefixes: Sequence[str]) -> Column:
        hit = F.lit(False)
        for prefix in prefixes:
            hit = hit | feature.startswith(prefix)
        return hit

    return (
        F.when(feature.endswith("_id"), "Identifiers")
        .when(feature.contains("price"), "Price")
        .when(feature.isin(*CALENDAR_NAMES) | starts(CALENDAR_PREFIXES), "Calendar and horizon")
        .when(starts(HISTORY_PREFIXES), "Demand history")
        .otherwise("Other")
    )


def attribution_long(frame: DataFrame) -> DataFrame:
    """(series_id, horizon, feature, value), one row per attribution."""
    features = attributed_features(frame)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(PREFIX + f).alias("value")) for f in features])
    return frame.select("series_id", "horizon", F.inline(pairs))


def attribution_global(frame: DataFrame, top: int | None = None) -> DataFrame:
    """Importance per feature with sign shares, rank and family; one row per feature."""
    if top is not None and top < 1:
        raise ValueError("top must be positive")
    value = F.col("value")
    per_feature = (
        attribution_long(frame)
        .groupBy("feature")
        .agg(
            F.avg(F.abs(value)).alias("mean_abs_shap"),
            F.avg(value).alias("mean_shap"),
            rate(value > 0).alias("positive_share"),
            rate(value < 0).alias("negative_share"),
        )
    )
    # Windows over the feature list only: as many rows as the model has features.
    everything = Window.partitionBy(F.lit(0))
    ranked = per_feature.select(
        F.row_number().over(everything.orderBy(F.desc("mean_abs_shap"), "feature")).alias("rank"),
        "feature",
        "mean_abs_shap",
        "mean_shap",
        "positive_share",
        "negative_share",
        (F.col("mean_abs_shap") / F.greatest(F.sum("mean_abs_shap").over(everything), F.lit(TINY))).alias(
            "importance_share"
        ),
        feature_family(F.col("feature")).alias("feature_group"),
    )
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def attribution_family(frame: DataFrame) -> DataFrame:
    return (
        attribution_global(frame)
        .groupBy("feature_group")
        .agg(F.sum("mean_abs_shap").alias("mean_abs_shap"), F.sum("importance_share").alias("importance_share"))
    )


def attribution_horizon(frame: DataFrame) -> DataFrame:
    """Importance and rank of each feature at each horizon (features x horizons rows)."""
    within = Window.partitionBy("horizon").orderBy(F.desc("mean_abs_shap"), "feature")
    return (
        attribution_long(frame)
        .groupBy("horizon", "feature")
        .agg(F.avg(F.abs("value")).alias("mean_abs_shap"))
        .withColumn("rank", F.row_number().over(within))
    )


def attribution_segment(frame: DataFrame) -> DataFrame:
    """Rows, series, total magnitude and leading feature per state, store and category.

    Magnitudes are summed per series first, so a segment holding most rows still
    aggregates from many tasks.
    """
    features = attributed_features(frame)
    by_series = frame.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.abs(PREFIX + f)).alias(f) for f in features]
    )
    category = F.regexp_extract("series_id", SERIES_PATTERN, 1)
    store = F.regexp_extract("series_id", SERIES_PATTERN, 2)
    parsed = by_series.withColumns({"_category": category, "_store": store}).where(F.col("_store") != "")
    segments = F.array(
        F.struct(F.lit("state").alias("segment_type"), F.substring_index("_store", "_", 1).alias("segment")),
        F.struct(F.lit("store").alias("segment_type"), F.col("_store").alias("segment")),
        F.struct(F.lit("category").alias("segment_type"), F.col("_category").alias("segment")),
    )
    sums = (
        parsed.select("n", *features, F.inline(segments))
        .groupBy("segment_type", "segment")
        .agg(
            F.sum("n").alias("row_count"),
            F.count(F.lit(1)).alias("series_count"),
            *[F.sum(f).alias(f) for f in features],
        )
    )
    means = F.array_sort(
        F.array(*[F.struct((-F.col(f) / F.col("row_count")).alias("minus"), F.lit(f).alias("feature")) for f in features])
    )
    total = F.lit(0.0)
    for f in features:
        total = total + F.col(f)
    leader = F.get(means, F.lit(0))
    return sums.select(
        "segment_type",
        "segment",
        "row_count",
        "series_count",
        (total / F.col("row_count")).alias("mean_total_abs_shap"),
        leader["feature"].alias("top_feature"),
        (-leader["minus"]).alias("top_feature_mean_abs_shap"),
    )


def attribution_local(frame: DataFrame, count: int = 10) -> DataFrame:
    """Rows with the largest total magnitude and their three strongest drivers.

    A bounded top-k report: each task keeps only its own leaders.
    """
    if count < 1:
        raise ValueError("count must be positive")
    features = attributed_features(frame)
    total = F.lit(0.0)
    for f in features:
        total = total + F.abs(PREFIX + f)
    leaders = (
        frame.withColumn("total_abs_shap", total)
        .orderBy(F.desc("total_abs_shap"), "series_id", "horizon")
        .limit(count)
    )
    drivers = F.array_sort(
        F.array(
            *[
                F.struct((-F.abs(PREFIX + f)).alias("minus"), F.lit(f).alias("feature"), F.col(PREFIX + f).alias("value"))
                for f in features
            ]
        )
    )
    first = F.get("_drivers", F.lit(0))
    told = F.transform(
        F.slice("_drivers", 1, 3), lambda d: F.format_string("%s (%+.3f)", d["feature"], d["value"])
    )
    return leaders.withColumn("_drivers", drivers).select(
        "series_id",
        "horizon",
        "total_abs_shap",
        first["feature"].alias("top_driver"),
        first["value"].alias("top_driver_shap"),
        F.when(first["value"] > 0, "raises forecast").otherwise("lowers forecast").alias("direction"),
        F.array_join(told, "; ").alias("top_three_drivers"),
    )


def attribution_summary(frame: DataFrame) -> DataFrame:
    """One row describing the whole attribution table."""
    overall = attribution_global(frame)
    by_rank = F.col("rank")
    shares = {
        "demand_history_share": "Demand history",
        "calendar_horizon_share": "Calendar and horizon",
        "identifier_share": "Identifiers",
        "price_share": "Price",
    }
    share = F.col("importance_share")
    importance = overall.agg(
        F.count(F.lit(1)).alias("feature_count"),
        F.max(F.when(by_rank == 1, F.col("feature"))).alias("top_feature"),
        F.max(F.when(by_rank == 1, F.col("mean_abs_shap"))).alias("top_feature_mean_abs_shap"),
        F.max(F.when(by_rank == 1, share)).alias("top_feature_share"),
        F.sum(F.when(by_rank <= 5, share).otherwise(0.0)).alias("top_five_share"),
        *[
            F.sum(F.when(F.col("feature_group") == family, share).otherwise(0.0)).alias(name)
            for name, family in shares.items()
        ],
    )
    extent = frame.agg(
        F.count(F.lit(1)).alias("sample_rows"),
        F.countDistinct("series_id").alias("series_count"),
        F.countDistinct("horizon").alias("horizon_count"),
    )
    # One row each on both sides; the leaders are one row per horizon.
    leaders = attribution_horizon(frame).where(by_rank == 1)
    led = leaders.crossJoin(F.broadcast(importance.select("top_feature"))).agg(
        F.count_if(F.col("feature") == F.col("top_feature")).alias("top_feature_horizon_count")
    )
    return extent.crossJoin(F.broadcast(importance)).crossJoin(F.broadcast(led))
