"""Record rules of the exchanged tables, reported as violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORECAST_COLUMNS = (
    "run_id", "model_name", "model_version", "origin_date", "target_date", "series_id", "item_id", "dept_id",
    "cat_id", "store_id", "state_id", "horizon", "yhat", "q05", "q50", "q95",
)
RECOMMENDATION_COLUMNS = (
    "run_id", "series_id", "as_of_date", "lead_time_days", "review_period_days", "service_level", "on_hand",
    "reorder_point", "order_up_to", "suggested_order_quantity", "assumption_source",
)


def forecast_rules() -> dict[str, Column]:
    values = {f"{c}_not_negative": F.col(c) >= 0 for c in ("yhat", "q05", "q50", "q95")}
    ordered = (F.col("q05") <= F.col("q50")) & (F.col("q50") <= F.col("q95"))
    return {"horizon_positive": F.col("horizon") > 0, **values, "quantiles_ordered": ordered}


def recommendation_rules() -> dict[str, Column]:
    amounts = ("on_hand", "reorder_point", "order_up_to", "suggested_order_quantity")
    return {
        "lead_time_positive": F.col("lead_time_days") > 0,
        "review_period_positive": F.col("review_period_days") > 0,
        "service_level_inside": (F.col("service_level") > 0) & (F.col("service_level") < 1),
        **{f"{c}_not_negative": F.col(c) >= 0 for c in amounts},
    }


def violations(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Broken rows, once per broken rule; a rule that yields null counts as broken."""
    named = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]
    return frame.select("*", F.explode(F.array_compact(F.array(*named))).alias("broken_rule"))


def rule_counts(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Checked rows and failures per rule, from one aggregation."""
    counted = frame.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(rule) for rule, ok in rules.items()],
    )
    pairs = [F.struct(F.lit(r).alias("rule"), F.col("_all").alias("checked"), F.col(r).alias("failures")) for r in rules]
    return counted.select(F.inline(F.array(*pairs)))


def require_exact_columns(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reject missing and unexpected columns before any job runs."""
    absent, extra = sorted(set(columns) - set(frame.columns)), sorted(set(frame.columns) - set(columns))
    if absent or extra:
        raise ValueError(f"columns do not match the contract: missing {absent}, unexpected {extra}")
    return frame.select(*columns)
