"""Named queries over the retail panel; each takes (spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.exprs import is_finite, model_label, own_snap
from demandloom.operators import (
    accuracy, adjust, attribution, baselines, contracts, features, hierarchy, inventory, learned, panel, profile,
    sampling, selection,
)
from demandloom.plans import jobs
from demandloom.plans.stages import Stages
from demandloom.settings import SERIES_KEYS, ReplayPolicy
from demandloom.sources import digests, retail
from demandloom.sources.tables import LINEAGE, read_table, staged, staging_root, stamped, without_lineage, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed weights of the checkable attribution table.
LINEAR_WEIGHTS = {
    "lag_1": 0.05, "lag_7": 0.1, "lag_28": -0.08, "rolling_mean_7": 0.4, "rolling_mean_28": 0.6,
    "nonzero_rate_28": 1.5, "days_since_last_sale": -0.02, "target_wday": 0.3, "target_month": -0.2,
    "target_snap_CA": 0.7, "target_sell_price": 0.00001, "price_missing": -0.9, "horizon": -0.01,
}

POLICY = ReplayPolicy()


def report(build: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    """Register a query under its function name; doubles are rounded to six places."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(Stages(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


def tidy(frame: DataFrame) -> DataFrame:
    doubles = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.DoubleType)]
    # The shift moves exact ties off the rounding boundary, where engines differ;
    # adding zero turns a rounded negative zero into zero.
    return frame.withColumns({c: F.round(F.col(c) + F.lit(1.37e-9), 6) + F.lit(0.0) for c in doubles})


# Panel ---------------------------------------------------------------------


@report
def demand_panel(s: Stages) -> DataFrame:
    return s.daily()


@report
def daily_sales(s: Stages) -> DataFrame:
    return s.sales()


@report
def weekly_prices(s: Stages) -> DataFrame:
    return s.prices()


@report
def wide_unpivot(s: Stages) -> DataFrame:
    return panel.normalize_sales(s.wide_table(), s.cfg)


@report
def csv_roundtrip_lineage(s: Stages) -> DataFrame:
    return jobs.csv_roundtrip_audit(s)


@report
def source_contract(s: Stages) -> DataFrame:
    return jobs.csv_source_report(s)


def customer_files(s: Stages) -> str:
    """Folder of text files, one line per customer in key order, 500 keys to a file."""
    folder = f"{staging_root(s.spark)}/customers-{uuid.uuid4().hex}"
    line = F.concat_ws("|", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("line")
    lines = s.spark.read.parquet(f"{s.sf_dir}/customer.parquet").select(
        F.expr("c_custkey div 500").alias("slice"), "c_custkey", line
    )
    placed = lines.repartition("slice").sortWithinPartitions("slice", "c_custkey", "line")
    placed.select("slice", "line").write.partitionBy("slice").text(folder)
    return folder


@report
def file_block_digests(s: Stages) -> DataFrame:
    """Size and digest of every customer file, hashed in blocks of 4,096 bytes."""
    found = digests.file_digests(s.spark, customer_files(s), "*.txt", block_bytes=4096)
    slice_ = F.regexp_extract("path", r"slice=(\d+)/", 1).cast("bigint").alias("slice")
    return found.select(slice_, "size_bytes", "sha256")


@report
def source_set_digest(s: Stages) -> DataFrame:
    """One digest of all customer files as one source, and of them with every file twice."""
    found = digests.file_digests(s.spark, customer_files(s), "*.txt")
    copies = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    both = found.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("times")).select("times", "size_bytes", "sha256", copies)
    return digests.set_digest(both, ["times"])


@report
def wide_structure(s: Stages) -> DataFrame:
    return jobs.csv_wide_structure(s)


@report
def stratified_series_sample(s: Stages) -> DataFrame:
    per_series = (
        s.dense()
        .groupBy("id", "state_id")
        .agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("day_count"))
    )
    return sampling.stratified_series(per_series, "id", "state_id", 12, s.cfg.seed)


@report
def hash_fraction_sample(s: Stages) -> DataFrame:
    keys = ["series_id", "origin_day", "horizon"]
    return sampling.sample_fraction(s.training(), keys, 0.1, s.cfg.seed).select(*keys, "target")


@report
def fixed_size_sample(s: Stages) -> DataFrame:
    keys = ["series_id", "horizon"]
    return sampling.sample_rows(s.future(), keys, 2000, s.cfg.seed).select(*keys, "lag_1")


@report
def panel_quality(s: Stages) -> DataFrame:
    return panel.validate_panel(s.daily())


@report
def duplicate_keys(s: Stages) -> DataFrame:
    return panel.duplicate_keys(retail.load(s.spark, s.sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@report
def panel_gaps(s: Stages) -> DataFrame:
    return panel.panel_gaps(s.sales_table())


@report
def state_snap_days(s: Stages) -> DataFrame:
    """Series-days and units on days when the series' own state has its programme."""
    flagged = s.daily_table().withColumn("own_snap", own_snap(F.col("state_id")))
    return flagged.groupBy("state_id", "own_snap").agg(F.count(F.lit(1)).alias("row_count"), F.sum("units").alias("units"))


@report
def lake_round_trip(s: Stages) -> DataFrame:
    """The panel stamped, written by state and year, read back without its lineage, and counted beside the reported rows."""
    lake = f"{staging_root(s.spark)}/lake-{uuid.uuid4().hex}"
    stamps = {name: "roundtrip" for name in LINEAGE}
    written = write_table(
        stamped(s.daily_table(), **stamps), lake, "silver", "sales_daily", ["state_id", "year"], sort_within=["series_id", "day_num"]
    )
    back = without_lineage(read_table(s.spark, lake, "silver", "sales_daily"))
    return back.groupBy("state_id", "year").agg(F.count(F.lit(1)).alias("row_count"), F.sum("units").alias("units")).withColumns(
        {"reported_rows": F.lit(written["rows"]), "columns": F.lit(len(back.columns))}
    )


# Profiles ------------------------------------------------------------------


@report
def demand_profile(s: Stages) -> DataFrame:
    return profile.demand_profile(s.daily_table())


@report
def series_activity(s: Stages) -> DataFrame:
    return profile.series_activity(s.daily_table())


@report
def intermittency_regimes(s: Stages) -> DataFrame:
    return profile.regime_summary(profile.series_activity(s.daily_table()))


@report
def retail_mix(s: Stages) -> DataFrame:
    return profile.retail_mix(s.daily_table())


@report
def price_profile(s: Stages) -> DataFrame:
    return profile.price_profile(s.daily_table())


@report
def monthly_units(s: Stages) -> DataFrame:
    return profile.monthly_units(s.daily())


# Features ------------------------------------------------------------------


@report
def origin_features(s: Stages) -> DataFrame:
    featured = features.add_origin_features(s.panel_until(s.cfg.forecast_origin), s.cfg)
    return featured.select("series_id", "day_num", *features.feature_columns(s.cfg))


@report
def origin_snapshot(s: Stages) -> DataFrame:
    return features.origin_snapshot(s.daily_table(), s.cfg.training_origins(), s.cfg)


@report
def target_lags(s: Stages) -> DataFrame:
    lagged = features.target_lag_columns(s.daily_table(), s.cfg)
    return lagged.select("series_id", "day_num", *[f"target_lag_{k}" for k in s.cfg.target_lags])


@report
def future_target_lags_pivot(s: Stages) -> DataFrame:
    origin = s.cfg.forecast_origin
    requests = s.panel_until(origin).select("series_id").distinct().withColumn(
        "target_day", F.explode(F.sequence(F.lit(origin + 1), F.lit(origin + s.cfg.horizon)))
    )
    return features.future_lag_pivot(requests, s.panel_until(origin), s.cfg)


@report
def direct_training_features(s: Stages) -> DataFrame:
    return features.build_direct_features(s.daily_table(), s.calendar(), s.cfg)


@report
def forecast_features(s: Stages) -> DataFrame:
    return features.build_forecast_features(s.daily_table(), s.calendar(), s.price_table(), s.cfg)


@report
def feature_shape(s: Stages) -> DataFrame:
    return features.feature_shape(s.training())


@report
def leakage_audit(s: Stages) -> DataFrame:
    return features.leakage_audit(s.training(), s.daily_table(), s.cfg)


@report
def future_blind_audit(s: Stages) -> DataFrame:
    origin = max(s.cfg.backtest_origins)
    return features.future_blind_audit(s.training(), s.blind_daily(origin), s.calendar(), origin, s.cfg)


@report
def feature_null_quantiles(s: Stages) -> DataFrame:
    return features.feature_distribution(s.training())


@report
def category_codes(s: Stages) -> DataFrame:
    return learned.fit_categories(s.training())


@report
def encoded_categories(s: Stages) -> DataFrame:
    known = s.training().where(F.col("origin_day") < 2000)
    dictionary = learned.fit_categories(known.where(F.col("store_id") != "WI_1"))
    codes = ["item_id", "store_id", "state_id", "target_event_type"]
    return (
        learned.encode_categories(s.training().withColumn("series", F.col("series_id")), dictionary)
        .groupBy(*codes)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


# Hierarchy -----------------------------------------------------------------


@report
def hierarchy_bridge(s: Stages) -> DataFrame:
    return hierarchy.build_bridge(s.daily_table())


@report
def hierarchy_rollup(s: Stages) -> DataFrame:
    return hierarchy.node_history(s.daily_table(), s.cfg.forecast_origin)


@report
def node_scales(s: Stages) -> DataFrame:
    nodes = hierarchy.node_history(s.daily_table(), max(s.cfg.backtest_origins))
    return hierarchy.node_scales(nodes, s.cfg.backtest_origins)


@report
def revenue_weights(s: Stages) -> DataFrame:
    nodes = hierarchy.node_history(s.daily_table(), max(s.cfg.backtest_origins))
    scales = hierarchy.node_scales(nodes, s.cfg.backtest_origins)
    weights = hierarchy.revenue_weights(scales, hierarchy.recent_revenue(s.daily_table(), s.cfg.backtest_origins))
    return weights.select("fold_origin", "level", "node_id", "weight")


@report
def hierarchical_wrmsse(s: Stages) -> DataFrame:
    return hierarchy.hierarchical_wrmsse(s.daily_table(), s.backtests(), s.cfg.backtest_origins)


@report
def infinite_zero_scale(s: Stages) -> DataFrame:
    """Errors per node where a node without a usable scale counts as infinite unless its forecast is exact."""
    details = hierarchy.hierarchical_wrmsse(s.daily_table(), s.backtests(), s.cfg.backtest_origins, zero_scale="inf")
    return details.select("model_name", "fold_origin", "level", "level_name", "node_id", "rmsse")


@report
def wrmsse_scores(s: Stages) -> DataFrame:
    return hierarchy.fold_scores(s.details())


@report
def bottom_rmsse(s: Stages) -> DataFrame:
    return hierarchy.bottom_rmsse(s.details())


@report
def series_rmsse(s: Stages) -> DataFrame:
    newest = max(s.cfg.backtest_origins)
    rows = s.backtests().where((F.col("model_name") == "moving_average") & (F.col("fold_origin") == newest))
    return hierarchy.series_rmsse(s.panel_until(newest), rows)


# Forecasts -----------------------------------------------------------------


@report
def seasonal_naive(s: Stages) -> DataFrame:
    return s.training().select("series_id", "origin_day", "horizon", baselines.seasonal_naive().alias("yhat"))


@report
def moving_average(s: Stages) -> DataFrame:
    return s.training().select("series_id", "origin_day", "horizon", baselines.moving_average().alias("yhat"))


@report
def residual_calibration(s: Stages) -> DataFrame:
    points = baselines.baseline_points(s.training())
    return baselines.fold_calibration(points, s.cfg.backtest_origins)


@report
def calibrated_intervals(s: Stages) -> DataFrame:
    return s.backtests().select("model_name", "fold_origin", "series_id", "horizon", "q05", "q50", "q95")


@report
def baseline_backtest(s: Stages) -> DataFrame:
    return baselines.backtest_baselines(s.training(), s.cfg)


@report
def level_factor(s: Stages) -> DataFrame:
    rows = baselines.training_rows(baselines.baseline_points(s.training()), s.cfg.backtest_origins)
    newest = rows.groupBy("fold_origin").agg(F.max("origin_day").alias("origin_day"))
    validation = rows.join(F.broadcast(newest), ["fold_origin", "origin_day"], "left_semi")
    return baselines.level_factor(validation, ["model_name", "fold_origin"])


@report
def final_forecast(s: Stages) -> DataFrame:
    return s.forecasts()


@report
def final_forecast_hierarchy(s: Stages) -> DataFrame:
    return hierarchy.hierarchy_rollup(
        s.forecasts(), ["yhat", "q05", "q50", "q95"], ["model_name", "origin_date", "target_date", "horizon"]
    )


@report
def bridge_forecast_hierarchy(s: Stages) -> DataFrame:
    bridge = hierarchy.build_bridge(s.future())
    return hierarchy.bridge_rollup(
        s.forecasts(), bridge, ["yhat", "q05", "q50", "q95"], ["model_name", "origin_date", "target_date", "horizon"]
    )


# Accuracy ------------------------------------------------------------------


@report
def point_metrics_by_fold(s: Stages) -> DataFrame:
    return accuracy.point_metrics(s.backtests(), ["model_name", "fold_origin"])


@report
def backtest_summary(s: Stages) -> DataFrame:
    return accuracy.backtest_summary(s.backtests())


@report
def wape_by_granularity(s: Stages) -> DataFrame:
    return accuracy.wape_by_granularity(s.backtests())


@report
def wape_pivot(s: Stages) -> DataFrame:
    return accuracy.wape_pivot(accuracy.wape_by_granularity(s.backtests()))


@report
def regime_errors(s: Stages) -> DataFrame:
    return accuracy.regime_errors(s.backtests(), "moving_average")


@report
def horizon_errors(s: Stages) -> DataFrame:
    return accuracy.horizon_errors(s.backtests())


@report
def segment_errors(s: Stages) -> DataFrame:
    return accuracy.segment_errors(s.backtests())


@report
def review_flag(s: Stages) -> DataFrame:
    return accuracy.review_flags(accuracy.wape_by_granularity(s.backtests()))


@report
def zero_demand_share(s: Stages) -> DataFrame:
    return accuracy.zero_demand_share(s.backtests())


@report
def fold_degradation(s: Stages) -> DataFrame:
    return selection.fold_degradation(hierarchy.fold_scores(s.details()))


@report
def model_summary(s: Stages) -> DataFrame:
    return selection.model_summary(s.backtests(), s.details())


@report
def select_winner(s: Stages) -> DataFrame:
    return selection.select_winner(s.summary(), s.cfg.guardrails).select("model_name", "mean_wrmsse", "eligible")


@report
def promotion_gate(s: Stages) -> DataFrame:
    incumbent = s.summary().where(F.col("model_name") == "seasonal_naive")
    gate = selection.promotion_gate(s.summary(), incumbent, s.cfg.guardrails)
    return gate.withColumn("reasons", F.array_join("reasons", ","))


@report
def accuracy_table(s: Stages) -> DataFrame:
    return selection.accuracy_table(s.summary(), s.backtests(), hierarchy.bottom_rmsse(s.details()))


@report
def model_labels(s: Stages) -> DataFrame:
    return s.backtests().groupBy("model_name").agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "label", model_label(F.col("model_name"))
    )


@report
def demand_outlook(s: Stages) -> DataFrame:
    return selection.demand_outlook(s.forecasts())


@report
def forecast_view(s: Stages) -> DataFrame:
    return selection.forecast_view(s.forecasts(), "CA_1", "FOODS").select(
        "series_id", "target_date", "yhat", "q05", "q50", "q95"
    )


@report
def top_series(s: Stages) -> DataFrame:
    return selection.top_series(s.forecasts(), 1)


# Post-processing -----------------------------------------------------------


def _judged(s: Stages) -> tuple[DataFrame, DataFrame]:
    """Moving-average points at the last validation origin and at the last evaluation origin."""
    points = baselines.baseline_points(s.training(), ["moving_average"])
    validation, evaluation = sorted(s.cfg.backtest_origins)[-2:]
    return points.where(F.col("origin_day") == validation), points.where(F.col("origin_day") == evaluation)


@report
def threshold_scale_grid(s: Stages) -> DataFrame:
    return adjust.threshold_scale_search(s.backtests(), ["model_name", "fold_origin"])


@report
def unbiased_scale_grid(s: Stages) -> DataFrame:
    return adjust.unbiased_scale_search(s.backtests(), ["model_name", "fold_origin"])


@report
def threshold_scale_applied(s: Stages) -> DataFrame:
    validation, evaluation = _judged(s)
    adjusted = adjust.apply_threshold_scale(evaluation, adjust.threshold_scale_search(validation))
    return accuracy.point_metrics(adjusted, [], intervals=False)


@report
def group_scale(s: Stages) -> DataFrame:
    calibration, scoring = _judged(s)
    parts = [
        accuracy.point_metrics(adjust.apply_group_scale(calibration, scoring, columns, prior), [], intervals=False)
        .withColumn("variant", F.lit(name))
        for name, (columns, prior) in adjust.GROUP_PRIORS.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


@report
def group_scale_factors(s: Stages) -> DataFrame:
    calibration, _ = _judged(s)
    return adjust.group_scales(calibration, ("store_id", "dept_id"), 100.0)


@report
def seasonal_mean(s: Stages) -> DataFrame:
    return s.training().select("series_id", "origin_day", "horizon", adjust.seasonal_mean().alias("yhat"))


@report
def seasonal_mean_blend(s: Stages) -> DataFrame:
    validation = s.training().where(F.col("origin_day") == sorted(s.cfg.backtest_origins)[-2]).select(
        "target", baselines.moving_average().alias("model"), adjust.seasonal_mean().alias("seasonal")
    )
    return adjust.blend_search(validation, "model", "seasonal")


# Inventory -----------------------------------------------------------------


def _blocks(s: Stages) -> DataFrame:
    return inventory.residual_blocks(s.backtests(), s.cfg.horizon)


def _levels(s: Stages, policies) -> DataFrame:
    return inventory.review_levels(
        inventory.latest_fold(s.backtests()), _blocks(s), policies, s.cfg.horizon, s.cfg.seed
    )


@report
def price_backfill(s: Stages) -> DataFrame:
    """Prices taken from the feature table where stored backtests lack them."""
    filled = inventory.with_unit_price(s.backtests().drop("unit_price"), s.training())
    return filled.select("model_name", "series_id", "fold_origin", "horizon", "unit_price")


@report
def residual_blocks(s: Stages) -> DataFrame:
    return _blocks(s).select("model_name", "fold_origin", "series_id", F.posexplode("block").alias("step", "residual"))


@report
def order_up_to_bootstrap(s: Stages) -> DataFrame:
    return _levels(s, [POLICY])


def _recommended(s: Stages) -> DataFrame:
    winner_blocks = _blocks(s).where(F.col("model_name") == s.winner())
    return inventory.recommendations(s.forecasts(), winner_blocks, POLICY, s.cfg.seed)


@report
def recommendations(s: Stages) -> DataFrame:
    return _recommended(s)


@report
def largest_order(s: Stages) -> DataFrame:
    return inventory.largest_order(_recommended(s)).select("series_id", "suggested_order_quantity")


# Attribution ---------------------------------------------------------------


def _attributed(s: Stages) -> DataFrame:
    rows = s.training().where(F.col("origin_day") == max(s.cfg.backtest_origins))
    return attribution.linear_attribution(rows, LINEAR_WEIGHTS, 1.0)


@report
def attribution_table(s: Stages) -> DataFrame:
    return _attributed(s)


@report
def attribution_global(s: Stages) -> DataFrame:
    return attribution.attribution_global(_attributed(s))


@report
def attribution_top(s: Stages) -> DataFrame:
    """The five features of the largest importance."""
    return attribution.attribution_global(_attributed(s), top=5)


@report
def attribution_family(s: Stages) -> DataFrame:
    return attribution.attribution_family(_attributed(s))


@report
def attribution_horizon(s: Stages) -> DataFrame:
    return attribution.attribution_horizon(_attributed(s))


@report
def attribution_segment(s: Stages) -> DataFrame:
    return attribution.attribution_segment(_attributed(s))


@report
def attribution_local(s: Stages) -> DataFrame:
    return attribution.attribution_local(_attributed(s))


@report
def attribution_summary(s: Stages) -> DataFrame:
    return attribution.attribution_summary(_attributed(s))


# Contracts -----------------------------------------------------------------


@report
def forecast_contract(s: Stages) -> DataFrame:
    return contracts.rule_counts(s.forecasts(), contracts.forecast_rules())


@report
def recommendation_contract(s: Stages) -> DataFrame:
    return contracts.rule_counts(_recommended(s), contracts.recommendation_rules())


# Learned models ------------------------------------------------------------
#
# Fitted numbers depend on the learner's arithmetic. Some of these queries return the results themselves (forecasts, errors,
# attributions) and have no SQL; beside each stands one that returns what must hold whatever the digits are.


def _sound(forecast: DataFrame, *keys: str) -> DataFrame:
    """Keys of every forecast row, whether its quantiles are ordered, and whether all are finite and non-negative."""
    points = ("yhat", "q05", "q50", "q95")
    return forecast.select(
        *keys,
        ((F.col("q05") <= F.col("q50")) & (F.col("q50") <= F.col("q95"))).alias("ordered"),
        reduce(and_, [is_finite(F.col(c)) & (F.col(c) >= 0) for c in points]).alias("valid"),
    )


_KEPT: dict[tuple, object] = {}
#: Settings of the boosted trees of these queries.
TREES = {"tweedie_trees": {"rounds": 10, "depth": 5, "step": 0.3}}


def _kept(s: Stages, name: str, build: Callable[[], object]) -> object:
    """A fitted model or a table of its results, made once per session."""
    key = (s.spark.sparkContext.applicationId, s.sf_dir, s.cfg, name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def _final_learned(s: Stages, kind: str) -> tuple[learned.DirectForecaster, DataFrame]:
    """The learner fitted on all that is known, and its forecasts; fitted once per session."""

    def build() -> tuple[learned.DirectForecaster, DataFrame]:
        forecaster, forecast = jobs.final_learned(s.training(), s.future(), kind, s.cfg, TREES.get(kind))
        return forecaster, staged(forecast, f"final-{kind}")

    return _kept(s, f"final-{kind}", build)


def _learned_fold(s: Stages, kind: str) -> DataFrame:
    """Forecasts of the newest fold; fitted once per session."""
    newest = max(s.cfg.backtest_origins)
    return _kept(s, f"fold-{kind}", lambda: staged(jobs.learned_fold(s.training(), newest, kind, s.cfg, TREES.get(kind)), f"fold-{kind}"))


def _learned_backtest(s: Stages, kind: str) -> DataFrame:
    return _sound(_learned_fold(s, kind), "model_name", "series_id", "origin_day", "horizon", "target")


@report
def tweedie_forecast(s: Stages) -> DataFrame:
    return _learned_backtest(s, "tweedie")


@report
def gbt_forecast(s: Stages) -> DataFrame:
    return _learned_backtest(s, "gbt")


FOLD_MODELS = ("tweedie", "gbt", "tweedie_trees")


def _fold_points(s: Stages) -> DataFrame:
    """Forecasts of the newest fold by the learned models and the baselines."""
    s.training()  # staged once, before the fits that read it
    frames = learned.side_by_side([partial(_learned_fold, s, kind) for kind in FOLD_MODELS])
    return reduce(DataFrame.unionByName, frames, s.backtests().where(F.col("fold_origin") == max(s.cfg.backtest_origins)))


@report
def learned_fold_forecasts(s: Stages) -> DataFrame:
    """All columns of the learned models' forecasts of the newest fold."""
    return _fold_points(s).where(F.col("model_name").isin(*FOLD_MODELS))


@report
def learned_fold_errors(s: Stages) -> DataFrame:
    """Errors of learned models and baselines on the newest fold."""
    return accuracy.point_metrics(_fold_points(s), ["model_name", "fold_origin"])


@report
def trees_against_naive(s: Stages) -> DataFrame:
    """Boosted trees must beat the seasonal naive forecast and the linear model, or the flag is false."""
    found = {r["model_name"]: r["wape"] for r in accuracy.point_metrics(_fold_points(s), ["model_name"]).collect()}
    mine = found["tweedie_trees"]
    rows = [("tweedie_trees", other, mine < found[other]) for other in ("seasonal_naive", "tweedie")]
    return s.spark.createDataFrame(rows, "model_name string, other string, better boolean")


@report
def tweedie_trees_forecast(s: Stages) -> DataFrame:
    return _learned_backtest(s, "tweedie_trees")


def _trees_losses(s: Stages) -> DataFrame:
    forecaster, _ = _final_learned(s, "tweedie_trees")
    rows = list(enumerate(forecaster.model.losses))
    falls = [(k, v, not k or v <= rows[k - 1][1]) for k, v in rows]
    return s.spark.createDataFrame(falls, "round int, loss double, falls boolean")


@report
def boosting_losses(s: Stages) -> DataFrame:
    """Mean training loss before the first round and after every round."""
    return _trees_losses(s)


@report
def boosting_loss_falls(s: Stages) -> DataFrame:
    return _trees_losses(s).select("round", "falls")


@report
def tree_attribution(s: Stages) -> DataFrame:
    """Shapley values of the boosted trees for every future row."""
    forecaster, _ = _final_learned(s, "tweedie_trees")
    return forecaster.explain(s.future())


@report
def tree_attribution_summary(s: Stages) -> DataFrame:
    """Importance by feature from the Shapley values of the boosted trees."""
    forecaster, _ = _final_learned(s, "tweedie_trees")
    return attribution.attribution_global(forecaster.explain(s.future()))


@report
def tree_attribution_sums(s: Stages) -> DataFrame:
    """Every future row: attributions and the base value give the prediction of the boosted trees."""
    forecaster, _ = _final_learned(s, "tweedie_trees")
    explained = forecaster.explain(s.future())
    total = reduce(lambda a, b: a + b, [F.col(f"{attribution.PREFIX}{c}") for c in forecaster.features], F.col("base_value"))
    summed = explained.select("series_id", "horizon", F.exp(total).alias("summed"))
    predicted = forecaster.raw(s.future()).select("series_id", "horizon", "yhat")
    close = F.abs(F.col("summed") - F.col("yhat")) <= 1e-9 * F.greatest(F.col("yhat"), F.lit(1.0))
    return summed.join(predicted, ["series_id", "horizon"]).select("series_id", "horizon", close.alias("adds_up"))


#: Trials, growth of the rows from rung to rung, and share of the rows of the last rung.
HALVING = {"trials": 6, "keep": 3, "fraction": 0.3}


def _halving(s: Stages) -> DataFrame:
    def build() -> DataFrame:
        train, _ = baselines.split_fold(s.training(), min(s.cfg.backtest_origins))
        _, table = learned.halving_search(train, "tweedie_trees", seed=s.cfg.seed, **HALVING)
        return staged(table, "halving")

    return _kept(s, "halving", build)


@report
def halving_rungs(s: Stages) -> DataFrame:
    """Every fit of the search over seven parameters, with its rows and error."""
    return _halving(s)


@report
def halving_structure(s: Stages) -> DataFrame:
    """Candidates and survivors of every rung, and whether the survivors have the lowest errors."""
    worst, best_lost = F.max(F.when(F.col("kept"), F.col("wape"))), F.min(F.when(~F.col("kept"), F.col("wape")))
    return _halving(s).groupBy("rung").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if("kept").alias("kept"),
        F.coalesce(worst <= best_lost, F.lit(True)).alias("lowest_kept"),
    )


def _grid_search(s: Stages) -> DataFrame:
    def build() -> DataFrame:
        train, _ = baselines.split_fold(s.training(), min(s.cfg.backtest_origins))
        return staged(learned.search_parameters(train, "tweedie", s.cfg.tune_fraction, s.cfg.seed)[1], "grid-search")

    return _kept(s, "grid-search", build)


@report
def grid_search_errors(s: Stages) -> DataFrame:
    """Every candidate of the grid with its error."""
    return _grid_search(s)


@report
def temporal_grid_search(s: Stages) -> DataFrame:
    table = _grid_search(s)
    lowest = table.agg(F.min("wape").alias("lowest"))  # one row
    return table.crossJoin(F.broadcast(lowest)).select(
        "kind",
        "candidate",
        F.col("parameters")["regParam"].alias("reg_param"),
        F.col("parameters")["variancePower"].alias("variance_power"),
        is_finite(F.col("wape")).alias("scored"),
        (~F.col("chosen") | (F.col("wape") == F.col("lowest"))).alias("chosen_is_lowest"),
    )


def _newest_split(s: Stages) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit, validation and evaluation rows of the newest fold."""
    train, evaluation = baselines.split_fold(s.training(), max(s.cfg.backtest_origins))
    return *baselines.validation_split(train), evaluation


def _hurdle(s: Stages) -> DataFrame:
    """Hurdle forecasts of the newest fold's validation and evaluation rows."""

    def build() -> DataFrame:
        fit_rows, validation, evaluation = _newest_split(s)
        both = stamped(validation, part="validation").unionByName(stamped(evaluation, part="evaluation"))
        return staged(learned.hurdle_forecast(fit_rows, both, s.cfg.seed), "hurdle-rows")

    return _kept(s, "hurdle", build)


@report
def hurdle_points(s: Stages) -> DataFrame:
    """Sale probability, amount and forecast of every row of the newest fold."""
    wanted = ("series_id", "origin_day", "horizon", "target", "sale_probability", "sale_amount", "yhat")
    return _hurdle(s).where("part = 'evaluation'").select(*wanted)


@report
def hurdle_forecast(s: Stages) -> DataFrame:
    product = F.col("sale_probability") * F.col("sale_amount")
    return _hurdle(s).where("part = 'evaluation'").select(
        "series_id",
        "horizon",
        "target",
        F.col("sale_probability").between(0, 1).alias("probable"),
        ((F.col("sale_amount") >= 0) & (F.abs(F.col("yhat") - product) <= 1e-9)).alias("product_holds"),
    )


def _objectives(s: Stages) -> DataFrame:
    def build() -> DataFrame:
        train, evaluation = baselines.split_fold(s.training(), max(s.cfg.backtest_origins))
        return staged(learned.compare_objectives(train, evaluation), "objectives")

    return _kept(s, "objectives", build)


@report
def objective_errors(s: Stages) -> DataFrame:
    """Errors of every loss, the hurdle and the seasonal mean on the newest fold: raw, unbiased, with threshold and scale."""
    _, validation, evaluation = _newest_split(s)
    means = [
        part.withColumn("yhat", adjust.seasonal_mean()).where(F.col("yhat").isNotNull()) for part in (validation, evaluation)
    ]
    hurdle = [_hurdle(s).where(F.col("part") == part) for part in ("validation", "evaluation")]
    rows = [("hurdle_expected_value", *learned.adjusted_errors(*hurdle)), ("seasonal_mean_5", *learned.adjusted_errors(*means))]
    return _objectives(s).unionByName(s.spark.createDataFrame(rows, f"variant string, {learned.ERROR_SCHEMA}"))


@report
def blend_on_evaluation(s: Stages) -> DataFrame:
    """The blend of boosted trees and seasonal mean chosen on the validation rows, scored on the evaluation rows."""
    fit_rows, validation, evaluation = _newest_split(s)
    model = learned.DirectForecaster("tweedie_trees", TREES["tweedie_trees"], s.cfg.seed).fit_model(fit_rows)
    rows = [learned.blend_errors(model, validation, evaluation)]
    return s.spark.createDataFrame(
        rows, "weight double, scale double, validation_wape double, evaluation_wape double, evaluation_bias double"
    )


@report
def objective_comparison(s: Stages) -> DataFrame:
    found = _objectives(s)
    return found.select(
        "variant",
        (F.col("scale") > 0).alias("scaled"),
        (is_finite(F.col("raw_wape")) & is_finite(F.col("adjusted_wape"))).alias("scored"),
        # an error is never smaller than the bias it contains
        ((F.col("raw_wape") >= F.abs("raw_bias") - 1e-9) & (F.col("adjusted_wape") >= F.abs("adjusted_bias") - 1e-9)).alias("consistent"),
    )


@report
def learned_final_rows(s: Stages) -> DataFrame:
    """All columns of the final forecasts of the linear model and the boosted trees."""
    return _final_learned(s, "tweedie")[1].unionByName(_final_learned(s, "tweedie_trees")[1])


@report
def glm_attribution_rows(s: Stages) -> DataFrame:
    """Attributions of the linear model for every future row."""
    return _final_learned(s, "tweedie")[0].explain(s.future())


@report
def learned_final_forecast(s: Stages) -> DataFrame:
    forecaster, forecast = _final_learned(s, "tweedie")
    bounded = F.lit(0.8 <= forecaster.factor <= 1.25)
    return _sound(forecast, *SERIES_KEYS, "origin_day", "horizon").withColumn("factor_bounded", bounded)


@report
def glm_attribution(s: Stages) -> DataFrame:
    """Every future row: its attributions and the base value give the model's own prediction."""
    forecaster, _ = _final_learned(s, "tweedie")
    explained = forecaster.explain(s.future())
    total = F.col("base_value")
    for name in attribution.attributed_features(explained):
        total = total + F.col(f"{attribution.PREFIX}{name}")
    # The attributed rows carry the horizon as the learner saw it.
    summed = explained.select("series_id", F.col("horizon").alias("_seen"), F.exp(total).alias("summed"))
    seen = learned.as_number("horizon", forecaster.linear)
    predicted = forecaster.raw(s.future()).select("series_id", "horizon", seen.alias("_seen"), "yhat")
    close = F.abs(F.col("summed") - F.col("yhat")) <= 1e-6 * F.greatest(F.col("yhat"), F.lit(1.0))
    return summed.join(predicted, ["series_id", "_seen"]).select("series_id", "horizon", close.alias("adds_up"))
