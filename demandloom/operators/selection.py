"""Model summaries, winner selection and the promotion gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import floored
from demandloom.operators.accuracy import POINT, backtest_summary, wape_by_granularity, wape_pivot
from demandloom.operators.hierarchy import fold_scores
from demandloom.settings import Guardrails

SUMMARY = (*POINT, "coverage", "mean_interval_width", "mean_pinball_loss")


def fold_degradation(scores: DataFrame, baseline: str = "seasonal_naive") -> DataFrame:
    """Worst relative increase of the score over the baseline in any fold, never below zero."""
    # One row per fold.
    reference = scores.where(F.col("model_name") == baseline).select(
        "fold_origin", F.col("wrmsse").alias("reference_wrmsse")
    )
    worse = F.max(F.col("wrmsse") / floored(F.col("reference_wrmsse")) - 1)
    return (
        scores.join(F.broadcast(reference), "fold_origin", "left")
        .groupBy("model_name")
        .agg(F.coalesce(F.greatest(worse, F.lit(0.0)), F.lit(0.0)).alias("max_fold_degradation"))
    )


def model_summary(backtests: DataFrame, details: DataFrame) -> DataFrame:
    """One row per model: mean weighted score, accuracy means and the fold stability measure."""
    scores = fold_scores(details)
    means = scores.groupBy("model_name").agg(
        F.avg("wrmsse").alias("mean_wrmsse"), F.avg("bottom_rmsse").alias("bottom_rmsse")
    )
    return (
        means.join(backtest_summary(backtests), "model_name")
        .join(fold_degradation(scores), "model_name")
        .select("model_name", "mean_wrmsse", *SUMMARY, "bottom_rmsse", "max_fold_degradation")
    )


def broken_guardrails(rails: Guardrails) -> dict[str, Column]:
    """Named conditions; a missing measure breaks its guardrail."""
    inside = F.col("coverage").between(rails.coverage_min, rails.coverage_max)
    return {
        "bias_guardrail": ~F.coalesce(F.abs("bias") <= rails.max_abs_bias, F.lit(False)),
        "coverage_guardrail": ~F.coalesce(inside, F.lit(False)),
        "fold_degradation_guardrail": ~F.coalesce(
            F.col("max_fold_degradation") <= rails.max_fold_degradation, F.lit(False)
        ),
    }


def select_winner(summary: DataFrame, rails: Guardrails) -> DataFrame:
    """Best score among models within all guardrails, or among all models when none qualifies."""
    eligible = F.lit(True)
    for broken in broken_guardrails(rails).values():
        eligible = eligible & ~broken
    return (
        summary.withColumn("eligible", eligible)
        .orderBy(F.desc("eligible"), "mean_wrmsse", "model_name")
        .limit(1)
    )


def promotion_gate(candidate: DataFrame, incumbent: DataFrame, rails: Guardrails) -> DataFrame:
    """Decide on each candidate row against the incumbent (which may be absent; of several the best score counts)."""
    held = incumbent.agg(F.min("mean_wrmsse").alias("_held"))
    judged = candidate.join(F.broadcast(held), F.lit(True), "left")
    required = F.col("_held") * (1 - rails.improvement)
    reasons = broken_guardrails(rails) | {
        "insufficient_wrmsse_improvement": F.col("_held").isNotNull()
        & ~F.coalesce(F.col("mean_wrmsse") <= required, F.lit(False))
    }
    listed = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in reasons.items()]))
    return judged.select("model_name", (F.size(listed) == 0).alias("promoted"), listed.alias("reasons"))


def accuracy_table(summary: DataFrame, backtests: DataFrame, bottom: DataFrame) -> DataFrame:
    """Stored scores next to freshly computed accuracy of the stored backtests."""
    return (
        summary.select("model_name", "mean_wrmsse")
        .join(backtest_summary(backtests), "model_name", "left")
        .join(bottom, "model_name", "left")
        .join(wape_pivot(wape_by_granularity(backtests)), "model_name", "left")
    )


def demand_outlook(forecasts: DataFrame) -> DataFrame:
    """Median demand by store, date and category."""
    return forecasts.groupBy("store_id", "target_date", "cat_id").agg(F.sum("q50").alias("q50"))


def forecast_view(forecasts: DataFrame, store: str, category: str, series: str | None = None) -> DataFrame:
    """Forecast rows of one store and category, optionally of one series."""
    chosen = forecasts.where((F.col("store_id") == store) & (F.col("cat_id") == category))
    return chosen if series is None else chosen.where(F.col("series_id") == series)


def top_series(forecasts: DataFrame, count: int = 1) -> DataFrame:
    """Series with the largest summed median forecast."""
    return (
        forecasts.groupBy("series_id")
        .agg(F.sum("q50").alias("median_units"))
        .orderBy(F.desc("median_units"), "series_id")
        .limit(count)
    )
