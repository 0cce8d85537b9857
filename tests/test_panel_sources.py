from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandloom.functions.exprs import day_number, model_label
from demandloom.operators import panel as ops
from demandloom.operators import profile
from demandloom.settings import Settings
from demandloom.sources import files, tables


def test_unpivot_sorts_days_by_number_and_keeps_every_cell(spark):
    wide = spark.createDataFrame(
        [("i_CA_1_evaluation", "i", "D_1", "D", "CA_1", "CA", 1, 10, 2)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d_1 int, d_10 int, d_2 int",
    )
    long = ops.normalize_sales(wide, Settings())
    assert [(r["d"], r["day_num"], r["units"]) for r in long.orderBy("day_num").collect()] == [
        ("d_1", 1, 1.0), ("d_2", 2, 2.0), ("d_10", 10, 10.0)
    ]
    assert long.first()["series_id"] == "i_CA_1"


def test_join_keeps_unpriced_rows_and_drops_undated_ones(spark):
    sales = spark.createDataFrame(
        [("s", "i", "A_1", "d_1", 1, 2.0), ("s", "i", "A_1", "d_2", 2, 3.0), ("s", "i", "A_1", "d_9", 9, 3.0)],
        "series_id string, item_id string, store_id string, d string, day_num int, units double",
    )
    cal = spark.createDataFrame([("d_1", 1, 11), ("d_2", 2, 12)], "d string, day_num int, wm_yr_wk int")
    prices = spark.createDataFrame([("A_1", "i", 11, 5.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    got = {r["day_num"]: (r["sell_price"], r["price_missing"]) for r in ops.join_daily(sales, cal, prices).collect()}
    assert got == {1: (5.0, False), 2: (None, True)}


def test_quality_report_and_gate(panel):
    daily, _ = panel
    report = ops.validate_panel(daily)
    assert ops.require_valid(report, "panel")["row_count"] == 240
    doubled = daily.unionByName(daily.limit(1))
    assert ops.validate_panel(doubled).first()["duplicate_keys"] == 1
    with pytest.raises(ValueError):
        ops.require_valid(ops.validate_panel(doubled), "panel")
    assert not ops.validate_panel(daily.where("false")).first()["valid"]
    assert not ops.validate_panel(daily.withColumn("units", F.lit(-1.0))).first()["valid"]
    assert ops.panel_gaps(daily).isEmpty()
    assert ops.panel_gaps(daily.where("day_num <> 30")).count() == 4


def test_densify_fills_zero_days_and_keeps_totals(spark):
    sales = spark.createDataFrame(
        [("i_A", "i", "D_1", "D", "A_1", "A", 2, 5.0), ("j_A", "j", "D_1", "D", "A_1", "A", 4, 1.0)],
        "series_id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, day_num int, units double",
    )
    dense = ops.densify(sales, 1, 4)
    assert dense.count() == 8 and dense.agg(F.sum("units")).first()[0] == 6.0
    assert ops.panel_gaps(dense).isEmpty()


def test_skewed_fact_join_gives_the_same_panel(spark, tmp_path):
    """A part with a third of all lines, joined without broadcast and with skew splitting."""
    from demandloom.sources import retail

    spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 1, id % 40 + 1) AS l_partkey", "id % 7 + 1 AS l_suppkey", "CAST(id % 9 + 1 AS DOUBLE) AS l_quantity",
        "CAST(id % 100 + 0.25 AS DOUBLE) AS l_extendedprice", "timestamp'1995-01-02' + make_dt_interval(CAST(id % 50 AS INT)) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, 41).selectExpr("id AS p_partkey", "concat('Brand#', id % 25 + 1) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1, 8).selectExpr("id AS s_suppkey", "CAST(id % 5 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(5).selectExpr("CAST(id AS INT) AS n_nationkey", "CAST(id AS INT) AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")

    def total():
        frame = retail.daily_sales(spark, str(tmp_path))
        return sorted(map(tuple, frame.collect()))

    plain = total()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
    }
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert total() == plain
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_csv_contract_lineage_and_strictness(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "sell_prices.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nCA_1,i,1,2.5\nCA_1,i,2,\n")
    (tmp_path / "calendar.csv").write_text("date,wm_yr_wk,d\n1995-01-02,1,d_1\n")
    report = {r["file"]: r for r in files.source_report(spark, root, ["sell_prices.csv", "calendar.csv", "absent.csv"]).collect()}
    assert report["sell_prices.csv"]["valid"] and report["sell_prices.csv"]["columns"] == 4
    assert report["calendar.csv"]["missing_required_columns"] == ["event_name_1", "snap_CA"] and not report["calendar.csv"]["valid"]
    assert not report["absent.csv"]["exists"] and report["absent.csv"]["size_bytes"] == 0
    import hashlib

    digest = {r["file"]: r["sha256"] for r in files.combined_digests(files.source_digests(spark, root)).collect()}
    assert digest["calendar.csv"] == hashlib.sha256((tmp_path / "calendar.csv").read_bytes()).hexdigest()
    prices = files.read_csv_strict(spark, f"{root}/sell_prices.csv", "sell_prices.csv")
    assert [f.dataType.simpleString() for f in prices.schema] == ["string", "string", "int", "double"]
    assert prices.where("sell_price IS NULL").count() == 1
    stamped = prices.withColumns(files.lineage_columns("sell_prices.csv", digest["sell_prices.csv"], "2025-01-01T00:00:00", "r1"))
    audit = files.lineage_audit({"sell_prices": stamped}).first()
    assert (audit["row_count"], audit["column_count"], audit["lineage_records"]) == (2, 8, 1)
    (tmp_path / "sell_prices.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nCA_1,i,oops,2.5\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        files.read_csv_strict(spark, f"{root}/sell_prices.csv", "sell_prices.csv").collect()


def test_tables_report_rows_and_partition(spark, tmp_path):
    frame = spark.range(10).withColumn("g", F.col("id") % 2)
    written = tables.write_table(frame, str(tmp_path), "gold", "t", ["g"], sort_within=["id"])
    assert written["rows"] == 10
    assert (tmp_path / "gold" / "t" / "g=1").is_dir()
    tables.write_table(frame.limit(3).drop("g"), str(tmp_path), "gold", "t")
    assert tables.read_table(spark, str(tmp_path), "gold", "t").count() == 3


def test_small_expressions(spark):
    row = spark.range(1).select(
        day_number(F.lit("d_17")).alias("a"), day_number(F.lit("x")).alias("b"),
        model_label(F.lit("nhits")).alias("c"), model_label(F.lit("my_model")).alias("d"),
    ).first()
    assert tuple(row) == (17, None, "N-HiTS", "My Model")


def test_profiles(panel):
    daily, _ = panel
    activity = profile.series_activity(daily)
    assert activity.where("series_id = 'HOBBIES_1_002_CA_2'").first()["demand_regime"] == "very_sparse"
    regimes = profile.regime_summary(activity).collect()
    assert sum(r["series_share"] for r in regimes) == pytest.approx(1.0)
    assert profile.demand_profile(daily).first()["series"] == 4
    assert profile.retail_mix(daily).count() == 3 and profile.price_profile(daily).count() == 2
