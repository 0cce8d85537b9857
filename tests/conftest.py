from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Settings for short panels."""
    from demandloom.settings import Settings

    return Settings(
        horizon=3, history_days=20, origin_step=3, forecast_origin=57, backtest_origins=(48, 51, 54),
        lags=(1, 2, 3, 4, 5, 6, 7, 14, 28), target_lags=(3, 7, 14), rolling=(7, 28), series_per_state=None,
    )


@pytest.fixture(scope="session")
def panel(spark):
    """Four dense series of 60 days with gaps in price, late first sales and one series without sales."""
    from pyspark.sql import functions as F

    from demandloom.sources.retail import calendar

    keys = [
        ("FOODS_1_001", "FOODS_1", "FOODS", "CA_1", "CA"),
        ("FOODS_1_001", "FOODS_1", "FOODS", "TX_1", "TX"),
        ("HOBBIES_1_002", "HOBBIES_1", "HOBBIES", "CA_1", "CA"),
        ("HOBBIES_1_002", "HOBBIES_1", "HOBBIES", "CA_2", "CA"),
    ]
    rows = []
    for n, (item, dept, cat, store, state) in enumerate(keys):
        for day in range(1, 61):
            units = float((day * (n + 3) + day // 5) % 7) if day > 5 * n and n < 3 else 0.0
            price = None if (day + n) % 9 == 0 else 2.0 + n + (day // 7) * 0.25
            rows.append((f"{item}_{store}", item, dept, cat, store, state, day, units, price))
    frame = spark.createDataFrame(
        rows,
        "series_id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "day_num int, units double, sell_price double",
    )
    days = calendar(spark, 60)
    return frame.join(days.drop("d"), "day_num").withColumn("price_missing", F.col("sell_price").isNull()), days
