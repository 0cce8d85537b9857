"""Descriptive profiles of the daily panel, rolled up from tallies.

The panel is reduced once to the number of days of each (series, units) pair; counts, moments, shares and exact
quantiles of any coarser group follow from those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import demand_regime
from demandloom.operators.quantiles import exact_quantiles

SERIES = ("series_id", "state_id", "cat_id", "dept_id")


def unit_tally(daily: DataFrame) -> DataFrame:
    """Days and date range of every (series, units) pair; summed inside the tasks before the shuffle."""
    return daily.groupBy(*SERIES, "units").agg(
        F.count(F.lit(1)).alias("days"), F.min("date").alias("from_date"), F.max("date").alias("to_date")
    )


def _days(condition: Column | None = None) -> Column:
    return F.sum("days" if condition is None else F.when(condition, F.col("days")).otherwise(0))


def _units(power: int = 1) -> Column:
    amount = F.col("days").cast("double")
    for _ in range(power):
        amount = amount * F.col("units")
    return F.sum(amount)


def _idle() -> Column:
    return F.col("units") == 0


def demand_profile(daily: DataFrame) -> DataFrame:
    """Counts, moments, zero share and the 50/90/99 % points of daily units; one row."""
    tally = unit_tally(daily)
    sums = tally.agg(
        _days().alias("n"), F.countDistinct("series_id").alias("series"), _days(_idle()).alias("idle"),
        _units().alias("s1"), _units(2).alias("s2"), F.min("from_date").alias("first_date"), F.max("to_date").alias("last_date"),
    )
    mean = F.col("s1") / F.col("n")
    points = exact_quantiles(tally, [], "units", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, weight="days", discrete=True)
    # Both sides have one row.
    return sums.crossJoin(F.broadcast(points)).select(
        F.coalesce("n", F.lit(0)).alias("row_count"),
        "series",
        F.col("s1").alias("total_units"),
        mean.alias("mean_daily_units"),
        F.sqrt(F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))).alias("std_daily_units"),
        (F.col("idle") / F.col("n")).alias("zero_rate"),
        "first_date",
        "last_date",
        "p50",
        "p90",
        "p99",
    )


def series_activity(daily: DataFrame) -> DataFrame:
    """Intermittency of each series and its demand regime."""
    per_series = unit_tally(daily).groupBy(*SERIES).agg(
        (_days(_idle()) / _days()).alias("zero_rate"), _units().alias("total_units"), _days(F.col("units") > 0).alias("selling_days")
    )
    return per_series.withColumns(
        {
            # Units are never negative, so all of them fall on selling days.
            "mean_nonzero_units": F.when(F.col("selling_days") > 0, F.col("total_units") / F.col("selling_days")),
            "demand_regime": demand_regime(F.col("zero_rate")),
        }
    )


def regime_summary(activity: DataFrame) -> DataFrame:
    """Regimes with their share of series and of demand."""
    sums = activity.groupBy("demand_regime").agg(
        F.count(F.lit(1)).alias("series"), F.sum("total_units").alias("units"), F.avg("zero_rate").alias("mean_zero_rate")
    )
    middle = exact_quantiles(activity, ["demand_regime"], "selling_days", {"median": 0.5}, discrete=True)
    whole = sums.agg(F.sum("series").alias("all_series"), F.sum("units").alias("all_units"))  # one row
    shares = {
        "series_share": F.col("series") / F.col("all_series"),
        "demand_share": F.col("units") / F.col("all_units"),
        "median_selling_days": F.col("median").cast("bigint"),
    }
    joined = sums.join(middle, "demand_regime").crossJoin(F.broadcast(whole))
    return joined.withColumns(shares).drop("all_series", "all_units", "median")


def retail_mix(daily: DataFrame) -> DataFrame:
    """Volume and intermittency by state and category."""
    keys, tally = ["state_id", "cat_id"], unit_tally(daily)
    sums = tally.groupBy(*keys).agg(
        F.countDistinct("series_id").alias("series"), _units().alias("units"), _days().alias("n"), _days(_idle()).alias("idle")
    )
    high = exact_quantiles(tally, keys, "units", {"p90_units": 0.9}, weight="days", discrete=True)
    return sums.join(high, keys).select(
        *keys, "series", "units", (F.col("units") / F.col("n")).alias("mean_daily_units"),
        (F.col("idle") / F.col("n")).alias("zero_rate"), "p90_units",
    )


def price_profile(daily: DataFrame) -> DataFrame:
    """Share of unpriced days and the price distribution per category."""
    tally = daily.groupBy("cat_id", "sell_price").agg(F.count(F.lit(1)).alias("days"))
    sums = tally.groupBy("cat_id").agg(
        (_days(F.col("sell_price").isNull()) / _days()).alias("missing_price_rate"),
        F.min("sell_price").alias("min_price"),
        F.max("sell_price").alias("max_price"),
    )
    levels = {"median_price": 0.5, "p90_price": 0.9}
    points = exact_quantiles(tally, ["cat_id"], "sell_price", levels, weight="days", discrete=True)
    return sums.join(points, "cat_id", "left")


def monthly_units(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.trunc("date", "month").alias("month")).agg(F.sum("units").alias("units"))
