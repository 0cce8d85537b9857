"""Layered table storage: ``<root>/<layer>/<table>``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LINEAGE = ("_source_file", "_source_sha256", "_ingested_at", "_run_id")


def table_path(root: str, layer: str, table: str) -> str:
    return "/".join((root.rstrip("/"), layer, table))


def read_table(spark: SparkSession, root: str, layer: str, table: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(table_path(root, layer, table))


def write_table(
    frame: DataFrame,
    root: str,
    layer: str,
    table: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    sort_within: Sequence[str] = (),
) -> dict[str, object]:
    """Replace a table and report its row count from the same job.

    The rows are counted by an observation riding on the write, so no second
    scan is needed. With partition columns the rows are rebalanced on them:
    adaptive execution then splits a partition value that holds a large share of
    the rows over several writers and merges small ones, so file sizes follow the
    advisory partition size.
    """
    path = table_path(root, layer, table)
    seen = Observation()
    counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = counted.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_within)
    writer = counted.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return {"path": path, "rows": seen.get["rows"]}


_LOCAL_FOLDER: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a temporary one only in a local session that names none."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="spark-demandloom-"))
    return _LOCAL_FOLDER[0]


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Materialise a frame as a table in the shared folder and read it back.

    Cuts lineage for multi-pass work (iterative fits, several consumers of an
    expensive frame). The written copy survives the loss of executors.
    """
    spark = frame.sparkSession
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def dropped(frame: DataFrame) -> None:
    """Delete the staged files that a frame reads, when no later plan needs them; other files stay."""
    spark = frame.sparkSession
    root, jvm = staging_root(spark), spark.sparkContext._jvm
    folders = {path.rsplit("/", 1)[0] for path in frame.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(root).toUri().getPath():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without_lineage(frame: DataFrame) -> DataFrame:
    return frame.drop(*LINEAGE)


def stamped(frame: DataFrame, **constants: object) -> DataFrame:
    """Add constant columns such as run id or model name."""
    return frame.withColumns({name: F.lit(value) for name, value in constants.items()})
