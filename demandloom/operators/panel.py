"""Daily panel: wide-to-long, densification, calendar and price joins, quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.exprs import day_number
from demandloom.operators.sampling import stratified_series
from demandloom.settings import SERIES_KEYS, Settings
from demandloom.sources.files import SALES_IDENTIFIERS

SQL_FOLDER = Path(__file__).resolve().parent.parent / "plans" / "sql"


def run_sql_file(spark: SparkSession, name: str, **frames: DataFrame) -> DataFrame:
    """Run a stored SQL text; ``{name}`` in the text refers to the frame passed as ``name``."""
    text = (SQL_FOLDER / name).read_text(encoding="utf-8")
    return spark.sql(text, **frames)


def normalize_sales(wide: DataFrame, cfg: Settings) -> DataFrame:
    """One row per series and day from one column per day.

    The day columns are packed into one array and exploded: a single generator
    per row, where a row expansion would carry one projection per day column.
    """
    days = sorted((c for c in wide.columns if c.startswith("d_")), key=lambda c: int(c[2:]))
    # Thousands of columns: one SQL text is parsed much faster than as many column objects.
    labels = F.expr(f"array({', '.join(repr(day) for day in days)})")
    packed = wide.select(*SALES_IDENTIFIERS, F.expr(f"array({', '.join(days)})").alias("_values"))
    if cfg.series_per_state is not None:
        packed = stratified_series(packed, "id", "state_id", cfg.series_per_state, cfg.seed)
    return packed.select(*SALES_IDENTIFIERS, F.posexplode("_values").alias("_position", "_value")).select(
        *SALES_IDENTIFIERS,
        F.get(labels, F.col("_position")).alias("d"),
        F.col("_value").cast("double").alias("units"),
    ).withColumns(
        {"day_num": day_number(F.col("d")), "series_id": F.concat_ws("_", "item_id", "store_id")}
    )


def widen_sales(daily: DataFrame, last_day: int) -> DataFrame:
    """Inverse of ``normalize_sales`` for a dense panel starting at day 1: one integer column per day."""
    day = F.struct("day_num", F.col("units").cast("int").alias("units"))
    packed = daily.groupBy(*SALES_IDENTIFIERS).agg(F.array_sort(F.collect_list(day)).alias("days"))
    return packed.selectExpr(
        *SALES_IDENTIFIERS, *[f"get(days, {i - 1}).units AS d_{i}" for i in range(1, last_day + 1)]
    )


def densify(sales: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Add a zero row for every series-day without sales.

    Zeros are appended and summed rather than joined in: one shuffle on the
    series keys, and the result stays partitioned by series.
    """
    zeros = (
        sales.select(*SERIES_KEYS)
        .distinct()
        .select(
            *SERIES_KEYS,
            F.explode(F.sequence(F.lit(first_day), F.lit(last_day))).alias("day_num"),
            F.lit(0.0).alias("units"),
        )
    )
    # A sale outside the calendar stops the job instead of vanishing from the panel.
    outside = F.raise_error(F.concat(F.lit("sale outside the calendar: day "), F.col("day_num").cast("string")))
    day = F.when(F.col("day_num").between(first_day, last_day), F.col("day_num")).otherwise(outside.cast("int"))
    observed = sales.select(*SERIES_KEYS, day.alias("day_num"), "units")
    return (
        observed.unionByName(zeros)
        .repartition(*SERIES_KEYS)
        .groupBy(*SERIES_KEYS, "day_num")
        .agg(F.sum("units").alias("units"))
        .withColumns(
            {
                "id": F.concat("series_id", F.lit("_evaluation")),
                "d": F.concat(F.lit("d_"), F.col("day_num").cast("string")),
            }
        )
    )


def join_daily(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Attach calendar (inner) and weekly price (left, null kept and flagged)."""
    return run_sql_file(
        sales.sparkSession, "daily_panel.sql", sales=sales, calendar=calendar, prices=prices
    )


def duplicate_keys(frame: DataFrame, keys: Sequence[str] = ("series_id", "day_num")) -> DataFrame:
    """Keys that occur more than once; add ``limit(1)`` to merely test for one."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def validate_panel(daily: DataFrame) -> DataFrame:
    """One-row quality report of a panel.

    Keys are counted first, so the report needs one shuffle on (series, day) with
    map-side combination, whatever share of the rows one series holds.
    """
    per_key = daily.groupBy("series_id", "day_num").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("units").alias("low"),
        F.count_if(F.col("date").isNull()).alias("undated"),
    )
    report = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.countDistinct("series_id").alias("series"),
        F.min("low").alias("min_units"),
        F.max("day_num").alias("max_day"),
        F.coalesce(F.sum("undated"), F.lit(0)).alias("missing_dates"),
        (F.count_if(F.col("copies") > 1) > 0).cast("int").alias("duplicate_keys"),
    )
    sound = (
        (F.col("row_count") > 0)
        & (F.col("series") > 0)
        & (F.col("min_units") >= 0)
        & (F.col("missing_dates") == 0)
        & (F.col("duplicate_keys") == 0)
    )
    return report.withColumn("valid", F.coalesce(sound, F.lit(False)))


def panel_gaps(daily: DataFrame) -> DataFrame:
    """Series whose row count differs from their day span; row frames need this to be empty."""
    return (
        daily.groupBy("series_id")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.max("day_num") - F.min("day_num") + 1).alias("day_span"),
        )
        .where(F.col("row_count") != F.col("day_span"))
    )


def require_dense(daily: DataFrame) -> None:
    """Stop the job when a series misses a day of its span."""
    gap = panel_gaps(daily).first()
    if gap is not None:
        raise ValueError(f"panel has gaps, first in {gap.asDict()}")


def require_valid(report: DataFrame, what: str) -> dict[str, object]:
    """Stop the job when a one-row report is not valid."""
    row = report.first()
    outcome = row.asDict() if row is not None else {"valid": False}
    if not outcome["valid"]:
        raise ValueError(f"{what} failed its checks: {outcome}")
    return outcome
