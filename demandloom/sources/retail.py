"""Retail panel inputs derived from the star-schema tables.

Items are part brands, stores are supplier regions and the sales day is the
ship date, so the fact scan, its two dimension joins and the daily aggregation
carry the volume of ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.settings import SERIES_KEYS

# Fixed values of the mapping.
DAY_ZERO = "1995-01-01"
LAST_DAY = 2499
LAST_WEEK = (LAST_DAY - 1) // 7 + 1
# A forecast reaches 28 days ahead: a price set five weeks before is known at every origin that asks for it.
PRICE_LEAD_WEEKS = 5
DEPARTMENTS = ("FOODS_1", "FOODS_2", "HOUSEHOLD_1", "HOUSEHOLD_2", "HOBBIES_1")
STORES = ("CA_1", "CA_2", "TX_1", "TX_2", "WI_1")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def item_dimension(part: DataFrame, key: str = "brand") -> DataFrame:
    """Items by ``key``: "brand" (25), "brand_type" (brand and first word of the type, 150) or "part" (one per part)."""
    suffix = {
        "brand": [],
        "brand_type": [F.substring_index("p_type", " ", 1)],
        "part": [F.col("p_partkey").cast("string")],
    }[key]
    brand = F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int")
    dept = _pick(DEPARTMENTS, F.floor((brand - 1) / 5))
    return part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws("_", dept, F.lpad(brand.cast("string"), 3, "0"), *suffix).alias("item_id"),
        dept.alias("dept_id"),
        F.substring_index(dept, "_", 1).alias("cat_id"),
    )


def store_dimension(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    store = _pick(STORES, F.col("n_regionkey"))
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"),
        store.alias("store_id"),
        F.substring_index(store, "_", 1).alias("state_id"),
    )


def daily_sales(spark: SparkSession, sf_dir: str, item_key: str = "brand") -> DataFrame:
    """(series keys, day_num) -> units, revenue for days with sales.

    No join hints: the dimensions grow with the data, so Spark's size threshold
    decides on broadcasting and adaptive execution splits a skewed key. Money is
    summed as a decimal, which makes the totals independent of the task layout.
    """
    lines = load(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.datediff(F.to_date("l_shipdate"), F.to_date(F.lit(DAY_ZERO))).alias("day_num"),
        "l_quantity",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )
    items = item_dimension(load(spark, sf_dir, "part"), item_key)
    stores = store_dimension(load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation"))
    return (
        lines.join(items, "l_partkey")
        .join(stores, "l_suppkey")
        .withColumn("series_id", F.concat_ws("_", "item_id", "store_id"))
        .groupBy(*SERIES_KEYS, "day_num")
        .agg(
            F.sum("l_quantity").alias("units"),
            F.sum("amount").cast("double").alias("revenue"),
        )
    )


def calendar(spark: SparkSession, last_day: int = LAST_DAY) -> DataFrame:
    """One row per day number, with week, event and programme flags."""
    days = spark.range(1, last_day + 1, numPartitions=1).select(F.col("id").cast("int").alias("day_num"))
    date = F.date_add(F.to_date(F.lit(DAY_ZERO)), F.col("day_num"))
    month_day = F.date_format("date", "MM-dd")
    dom = F.dayofmonth("date")
    name = (
        F.when(month_day == "01-01", "NewYear")
        .when(month_day == "07-04", "IndependenceDay")
        .when(month_day == "12-25", "Christmas")
        .when(month_day == "02-14", "ValentinesDay")
        .when(month_day == "10-31", "Halloween")
    )
    kind = F.when(month_day.isin("01-01", "07-04", "12-25"), "National").when(
        month_day.isin("02-14", "10-31"), "Cultural"
    )
    return days.withColumn("date", date).select(
        F.concat(F.lit("d_"), F.col("day_num").cast("string")).alias("d"),
        "day_num",
        "date",
        (F.floor((F.col("day_num") - 1) / 7) + 1).cast("int").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.col("day_num") % 7 + 1).alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        name.alias("event_name_1"),
        kind.alias("event_type_1"),
        F.lit(None).cast("string").alias("event_name_2"),
        F.lit(None).cast("string").alias("event_type_2"),
        (dom <= 10).cast("int").alias("snap_CA"),
        ((dom % 2 == 1) & (dom <= 15)).cast("int").alias("snap_TX"),
        dom.between(5, 15).cast("int").alias("snap_WI"),
    )


def weekly_prices(sales: DataFrame, last_week: int = LAST_WEEK, lead: int = PRICE_LEAD_WEEKS) -> DataFrame:
    """Price list per store, item and week: the newest average selling price known ``lead`` weeks before.

    A list is set in advance, so a week's price never depends on sales of that week or of the weeks that a forecast
    for it would have to predict. The price of a week with sales holds from ``lead`` weeks later until the next such
    week's takes over; there is none before an item's first sale has become known.
    """
    week = (F.floor((F.col("day_num") - 1) / 7) + 1).cast("int")
    by_item = Window.partitionBy("store_id", "item_id").orderBy("_seen")
    known = (
        sales.groupBy("store_id", "item_id", week.alias("_seen"))
        .agg(
            F.sum(F.col("revenue").cast("decimal(18,2)")).cast("double").alias("revenue"),
            F.sum("units").alias("units"),
        )
        .withColumn("_first", F.col("_seen") + lead)
        .withColumn("_last", F.least(F.coalesce(F.lead("_seen").over(by_item) + (lead - 1), F.lit(last_week)), F.lit(last_week)))
        .where(F.col("_first") <= F.col("_last"))
    )
    return known.select(
        "store_id",
        "item_id",
        F.explode(F.sequence("_first", "_last")).alias("wm_yr_wk"),
        (F.col("revenue") / F.col("units")).alias("sell_price"),
    )
