"""Typed CSV ingestion with lineage and source contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.sources.digests import file_digests, set_digest

# Columns each source file must offer.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "calendar.csv": ("date", "wm_yr_wk", "d", "event_name_1", "snap_CA"),
    "sell_prices.csv": ("store_id", "item_id", "wm_yr_wk", "sell_price"),
    "sales_train_evaluation.csv": (
        "id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d_1", "d_1941",
    ),
    "sales_train_validation.csv": ("id", "item_id", "store_id", "d_1", "d_1913"),
    "sample_submission.csv": ("id", "F1", "F28"),
}

SALES_IDENTIFIERS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")

PRICE_SCHEMA = "store_id string not null, item_id string not null, wm_yr_wk int not null, sell_price double"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file: its header only, no type inference over the body."""
    return spark.read.option("header", True).csv(path).columns


def schema_for(file_name: str, header: Sequence[str]) -> T.StructType | None:
    """Declared schema for the sales and price files; None lets Spark infer."""
    if file_name.startswith("sales_train"):
        fields = [
            T.StructField(name, T.StringType() if name in SALES_IDENTIFIERS else T.IntegerType())
            for name in header
        ]
        return T.StructType(fields)
    if file_name == "sell_prices.csv":
        return T._parse_datatype_string(PRICE_SCHEMA)
    return None


def read_csv_strict(spark: SparkSession, path: str, file_name: str) -> DataFrame:
    """CSV scan that aborts on the first malformed record."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    declared = schema_for(file_name, csv_header(spark, path))
    if declared is not None:
        return reader.schema(declared).csv(path)
    return reader.option("inferSchema", True).csv(path)


def source_digests(spark: SparkSession, root: str) -> DataFrame:
    """(file, part, size_bytes, sha256) per physical file, hashed by executors in blocks.

    A source may be one file of any size or a folder of part files.
    """
    relative = F.regexp_extract("path", r"([^/]+\.csv)(?:/[^/]*)?$", 1)
    found = file_digests(spark, root, "*.csv")
    return found.select(relative.alias("file"), F.col("path").alias("part"), "size_bytes", "sha256")


def combined_digests(digests: DataFrame) -> DataFrame:
    """One checksum per source: the digest of its only part, or of the set of its parts."""
    return set_digest(digests, ["file"])


def source_report(
    spark: SparkSession,
    root: str,
    files: Sequence[str],
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
) -> DataFrame:
    """One row per expected file: existence, size, column count, missing columns, validity."""
    found = combined_digests(source_digests(spark, root))
    present = {row["file"] for row in found.where(F.col("file").isin(*files)).select("file").collect()}
    headers = {name: csv_header(spark, f"{root}/{name}") if name in present else [] for name in files}
    expected = spark.createDataFrame(
        [(name, headers[name], list(required.get(name, ()))) for name in files],
        "file string, header array<string>, required array<string>",
    )
    size = F.coalesce("size_bytes", F.lit(0))
    return (
        expected.join(found.select("file", "size_bytes"), "file", "left")
        .select(
            "file",
            (size > 0).alias("exists"),
            size.alias("size_bytes"),
            F.size("header").alias("columns"),
            F.array_sort(F.array_except("required", "header")).alias("missing_required_columns"),
        )
        .withColumn("valid", F.col("exists") & (F.size("missing_required_columns") == 0))
    )


def lineage_columns(file_name: str, digest: str, ingested_at: str, run_id: str) -> dict[str, Column]:
    return {
        "_source_file": F.lit(file_name),
        "_source_sha256": F.lit(digest),
        "_ingested_at": F.lit(ingested_at).cast("timestamp"),
        "_run_id": F.lit(run_id),
    }


def lineage_audit(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and number of distinct lineage records per table; a sound table has one."""
    audits = [
        frame.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(frame.columns)).alias("column_count"),
            F.countDistinct("_source_file", "_source_sha256", "_run_id").alias("lineage_records"),
            F.min("_source_file").alias("source_file"),
            F.min("_run_id").alias("run_id"),
        )
        for name, frame in frames.items()
    ]
    result = audits[0]
    for audit in audits[1:]:
        result = result.unionByName(audit)
    return result


def wide_structure(sales: DataFrame) -> DataFrame:
    """Shape of the wide sales table: rows, id columns, day columns, first and last day."""
    days = sorted((c for c in sales.columns if c.startswith("d_")), key=lambda c: int(c[2:]))
    return sales.agg(
        F.count(F.lit(1)).alias("series_rows"),
        F.lit(len(SALES_IDENTIFIERS)).alias("identifier_columns"),
        F.lit(len(days)).alias("daily_columns"),
        F.lit(days[0]).alias("first_day"),
        F.lit(days[-1]).alias("last_day"),
    )
