"""Order-up-to levels and order recommendations from residual blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import hash_number, non_negative, text_hash
from demandloom.operators.sampling import enumerate_rows
from demandloom.settings import ReplayPolicy
from demandloom.sources.tables import dropped, staged

# Numbers of a sample that may be broadcast.
SAMPLE_LIMIT = 20_000_000
BLOCK_KEYS = ("model_name", "fold_origin", "series_id")


def residual_blocks(backtests: DataFrame, horizon: int, exclude_fold: int | None = None) -> DataFrame:
    """One residual vector of ``horizon`` entries per model, fold and series; gaps are 0."""
    used = backtests if exclude_fold is None else backtests.where(F.col("fold_origin") != exclude_fold)
    steps = list(range(1, horizon + 1))
    wide = (
        used.withColumn("_residual", F.col("target") - F.col("yhat"))
        .groupBy(*BLOCK_KEYS)
        .pivot("horizon", steps)
        .agg(F.avg("_residual"))
    )
    return wide.select(*BLOCK_KEYS, F.array(*[F.coalesce(F.col(str(h)), F.lit(0.0)) for h in steps]).alias("block"))


def scenario_rows(policies: Sequence[ReplayPolicy]) -> Column:
    """Generator of one set of policy columns per scenario; the scenarios are a literal list."""
    names = {
        "policy": "name", "lead_days": "lead_days", "review_days": "review_days",
        "service_level": "service_level", "order_cost": "order_cost",
        "annual_holding_rate": "annual_holding_rate", "stockout_multiplier": "stockout_multiplier",
    }
    rows = [
        F.struct(
            *[F.lit(getattr(p, field)).alias(column) for column, field in names.items()],
            F.lit(p.initial_on_hand).cast("double").alias("initial_on_hand"),
        )
        for p in policies
    ]
    return F.inline(F.array(*rows))


def sampled_paths(blocks: DataFrame, draws: Sequence[int], paths: int, seed: int) -> DataFrame:
    """(model, draw) -> array of ``paths`` residual blocks, drawn with replacement.

    A draw stands for a review day; every series of a model sees the same sample
    on the same day. Blocks are numbered by a distributed row number, and each
    path hashes to one number. The result holds models x draws x paths blocks:
    fixed by the parameters, independent of the number of series.
    """
    numbered = enumerate_rows(blocks, ["fold_origin", "series_id"], ["model_name"], seed)
    # One row per model.
    sizes = blocks.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
    picks = (
        sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))).alias("path"))
        .select("*", F.explode(F.array(*[F.lit(d) for d in draws])).alias("draw"))
        .select(
            "model_name",
            "draw",
            "path",
            (hash_number(text_hash(F.lit(seed) + F.col("draw"), F.col("path"))) % F.col("n")).alias("row_index"),
        )
    )
    drawn = numbered.select("model_name", "row_index", "block").join(F.broadcast(picks), ["model_name", "row_index"])
    return drawn.groupBy("model_name", "draw").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("path", "block"))), lambda s: s["block"]).alias("sample")
    )


def order_up_to(windows: DataFrame, samples: DataFrame) -> DataFrame:
    """Level per row of ``windows`` (model_name, draw, point array, service_level).

    For every path the forecasts of the window and the path's residuals are
    added, cut at zero and summed; the level is the service quantile over the
    paths. Residuals repeat when a window is longer than a block. Without
    residuals the level is the plain forecast sum; an empty window needs nothing.

    Each window costs paths x days additions, which array lambdas would
    interpret one by one, so the arithmetic runs on Arrow batches. The sample is
    broadcast after a check of its size (models x draws x paths blocks, fixed by
    the parameters); the windows are partitioned by Spark and never leave the tasks.
    """
    samples = staged(samples, "sampled-blocks")  # drawn once, then measured and read
    size = samples.agg(F.sum(F.size("sample") * F.size(F.get("sample", F.lit(0))))).first()[0] or 0
    if size > SAMPLE_LIMIT:
        raise ValueError(f"a sample of {size} numbers is too large to broadcast; use fewer paths or models at a time")
    table = samples.toArrow().to_pydict()
    dropped(samples)
    drawn = samples.sparkSession.sparkContext.broadcast(
        {
            (model, draw): np.array(sample, dtype=float)
            for model, draw, sample in zip(table["model_name"], table["draw"], table["sample"], strict=True)
        }
    )

    @F.pandas_udf("double")
    def level(model: pd.Series, draw: pd.Series, point: pd.Series, service: pd.Series) -> pd.Series:
        days = point.map(len)
        result = pd.Series(0.0, index=point.index)
        for (name, day, length, share), rows in point.groupby([model, draw, days, service]):
            if length == 0:
                continue
            forecast = np.stack(rows.to_numpy()).astype(float)
            sample = drawn.value.get((name, day))
            if sample is None:
                result.loc[rows.index] = forecast.sum(axis=1)
                continue
            errors = np.take(sample, np.arange(length) % sample.shape[1], axis=1)
            for start in range(0, len(rows), 128):
                chunk = forecast[start : start + 128]
                totals = np.zeros((len(chunk), len(errors)))
                for j in range(length):
                    totals += np.maximum(chunk[:, j, None] + errors[None, :, j], 0.0)
                result.loc[rows.index[start : start + 128]] = np.quantile(totals, share, axis=1)
        return result

    return windows.withColumn("level", level("model_name", "draw", "point", "service_level"))


def _series_days(forecasts: DataFrame) -> DataFrame:
    """One row per model and series with its days in date order; length bounded by the horizon."""
    day = F.struct("target_date", "target", "yhat", "unit_price")
    return forecasts.groupBy("model_name", "series_id").agg(F.array_sort(F.collect_list(day)).alias("days"))


def review_levels(
    forecasts: DataFrame, blocks: DataFrame, policies: Sequence[ReplayPolicy], horizon: int, seed: int
) -> DataFrame:
    """Order-up-to level per policy, model, series and review day (first day = 0)."""
    paths = policies[0].paths
    if any(p.paths != paths for p in policies):
        raise ValueError("policies that share a sample must use the same number of paths")
    draws = sorted({d for p in policies for d in range(0, horizon, p.review_days)})
    reviews = F.filter(
        F.sequence(F.lit(0), F.size("days") - 1), lambda d: d % F.col("review_days") == 0
    )
    windows = (
        _series_days(forecasts)
        .select("*", scenario_rows(policies))
        .select("*", F.explode(reviews).alias("draw"))
        .select(
            "policy",
            "model_name",
            "series_id",
            "draw",
            "service_level",
            F.transform(
                F.slice("days", F.col("draw") + 1, F.col("lead_days") + F.col("review_days")), lambda s: s["yhat"]
            ).alias("point"),
        )
    )
    samples = sampled_paths(blocks, draws, paths, seed)
    return order_up_to(windows, samples).select(
        "policy", "model_name", "series_id", F.col("draw").alias("day_index"), "level"
    )


def recommendations(forecasts: DataFrame, blocks: DataFrame, policy: ReplayPolicy, seed: int) -> DataFrame:
    """Reorder point, order-up-to level and suggested order per series.

    Stock on hand is not observed and is set to the reorder point.
    """
    day = F.struct("target_date", "yhat")
    series = forecasts.groupBy("model_name", "series_id").agg(
        F.array_sort(F.collect_list(day)).alias("days"), F.min("origin_date").alias("as_of_date")
    )
    spans = F.array(
        F.struct(F.lit("reorder_point").alias("what"), F.lit(policy.lead_days).alias("span")),
        F.struct(F.lit("order_up_to").alias("what"), F.lit(policy.protection_days).alias("span")),
    )
    windows = series.select("model_name", "series_id", "as_of_date", "days", F.inline(spans)).select(
        "model_name",
        "series_id",
        "as_of_date",
        "what",
        F.lit(0).alias("draw"),
        F.lit(policy.service_level).alias("service_level"),
        F.transform(F.slice("days", F.lit(1), F.col("span")), lambda s: s["yhat"]).alias("point"),
    )
    samples = sampled_paths(blocks, [0], policy.paths, seed)
    levels = order_up_to(windows, samples)
    both = levels.groupBy("model_name", "series_id", "as_of_date").agg(
        F.max(F.when(F.col("what") == "reorder_point", F.col("level"))).alias("reorder_point"),
        F.max(F.when(F.col("what") == "order_up_to", F.col("level"))).alias("order_up_to"),
    )
    return both.select(
        "series_id",
        "as_of_date",
        F.lit(policy.lead_days).alias("lead_time_days"),
        F.lit(policy.review_days).alias("review_period_days"),
        F.lit(policy.service_level).alias("service_level"),
        F.col("reorder_point").alias("on_hand"),
        "reorder_point",
        "order_up_to",
        non_negative(F.col("order_up_to") - F.col("reorder_point")).alias("suggested_order_quantity"),
        F.lit("synthetic_configurable").alias("assumption_source"),
    )


def largest_order(recommended: DataFrame) -> DataFrame:
    return recommended.orderBy(F.desc("suggested_order_quantity"), "series_id").limit(1)


def latest_fold(backtests: DataFrame) -> DataFrame:
    """Rows of the newest fold; the fold number is a one-row aggregate."""
    newest = backtests.agg(F.max("fold_origin").alias("fold_origin"))
    return backtests.join(F.broadcast(newest), "fold_origin", "left_semi")


def with_unit_price(backtests: DataFrame, features: DataFrame) -> DataFrame:
    """Take prices from the feature table when the backtests do not carry them."""
    if "unit_price" in backtests.columns:
        return backtests
    keys = ["series_id", "origin_day", "horizon"]
    prices = features.select(*keys, F.col("target_sell_price").alias("unit_price")).dropDuplicates(keys)
    return backtests.join(prices, keys, "left")

