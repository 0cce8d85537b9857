"""Intermediate tables of the retail panel.

Jobs hand tables to each other through storage. ``Stages`` does the same for
ad-hoc queries: a table that several steps read is written once per session to
the shared staging folder and read back from there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators import baselines, features, hierarchy, panel, selection
from demandloom.settings import DEFAULTS, Settings
from demandloom.sources import retail
from demandloom.sources.tables import staged, staging_root

_BUILT: dict[tuple[str, str, Settings, str], DataFrame] = {}
_EXPORTED: dict[tuple[str, str], str] = {}


class Stages:
    """Tables derived from one set of source tables under one configuration."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Settings = DEFAULTS, item_key: str = "brand") -> None:
        self.spark, self.sf_dir, self.cfg, self.item_key = spark, sf_dir, cfg, item_key

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.cfg, f"{self.item_key}-{name}")
        if key not in _BUILT:
            _BUILT[key] = staged(build(), name)
        return _BUILT[key]

    # Views: cheap plans over the source tables.

    def sales(self) -> DataFrame:
        return retail.daily_sales(self.spark, self.sf_dir, self.item_key)

    def calendar(self) -> DataFrame:
        return retail.calendar(self.spark)

    # Tables: written once, read by several steps.

    def sales_table(self) -> DataFrame:
        """Daily sales, so that the fact table is scanned and joined once."""
        return self._once("sales", self.sales)

    def prices(self) -> DataFrame:
        return retail.weekly_prices(self.sales_table())

    def dense(self) -> DataFrame:
        return panel.densify(self.sales_table(), 1, retail.LAST_DAY)

    def wide_table(self) -> DataFrame:
        """One row per series and one column per day."""
        return self._once("wide", lambda: panel.widen_sales(self.dense(), retail.LAST_DAY))

    def daily(self) -> DataFrame:
        return panel.join_daily(self.dense(), self.calendar(), self.prices())

    def daily_table(self) -> DataFrame:
        return self._once("daily", self.daily)

    def price_table(self) -> DataFrame:
        return self._once("prices", self.prices)

    def training(self) -> DataFrame:
        return self._once(
            "training", lambda: features.build_direct_features(self.daily_table(), self.calendar(), self.cfg)
        )

    def future(self) -> DataFrame:
        return self._once(
            "future",
            lambda: features.build_forecast_features(
                self.daily_table(), self.calendar(), self.price_table(), self.cfg
            ),
        )

    def backtests(self) -> DataFrame:
        return self._once("backtests", lambda: baselines.backtest_baselines(self.training(), self.cfg))

    def details(self) -> DataFrame:
        return self._once(
            "details",
            lambda: hierarchy.hierarchical_wrmsse(self.daily_table(), self.backtests(), self.cfg.backtest_origins),
        )

    def summary(self) -> DataFrame:
        return self._once("summary", lambda: selection.model_summary(self.backtests(), self.details()))

    def blind_daily(self, origin: int) -> DataFrame:
        """The panel as it would be if nothing had been sold after the origin."""
        sold = self.sales_table().where(F.col("day_num") <= origin)
        dense = panel.densify(self.sales_table().withColumn("units", F.when(F.col("day_num") <= origin, F.col("units")).otherwise(0.0)), 1, retail.LAST_DAY)
        return panel.join_daily(dense, self.calendar(), retail.weekly_prices(sold))

    def forecasts(self, model: str | None = None) -> DataFrame:
        """Bottom-level forecasts of one baseline, the winner by default, from the final origin."""
        model = model or self.winner()
        return self._once(
            f"forecasts-{model}",
            lambda: baselines.final_baseline(self.training(), self.future(), model, self.cfg).drop("fold_origin"),
        )

    def winner(self) -> str:
        """Name of the selected model; found once per session."""
        return self._once(
            "winner", lambda: selection.select_winner(self.summary(), self.cfg.guardrails).select("model_name")
        ).first()["model_name"]

    def csv_folder(self, export: Callable[[str], None]) -> str:
        """Folder of CSV sources, written by ``export`` on first use."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _EXPORTED:
            folder = f"{staging_root(self.spark)}/csv-{uuid.uuid4().hex}"
            export(folder)
            _EXPORTED[key] = folder
        return _EXPORTED[key]

    def panel_until(self, day: int) -> DataFrame:
        return self.daily_table().where(F.col("day_num") <= day)
