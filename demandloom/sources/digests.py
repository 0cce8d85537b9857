"""SHA-256 digests of stored files of any size.

A file is cut into blocks that are hashed by separate tasks, each read as a byte range in small pieces, and the block
digests are combined in order as a hash tree. No task holds a file, and no group holds more than ``fan_out`` digests. A
file of one block has the plain SHA-256 of its bytes.

Defined cases: Spark's listing leaves out empty files, so they have no row and do not change the digest of a set; a file
that shrinks after it was listed stops the job; a folder without matching files gives no rows. Files are read through pyarrow's file systems, which must know the scheme.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 64 * 1024 * 1024
FAN_OUT = 4096
#: Bytes that a task holds at once.
PIECE_BYTES = 1024 * 1024
#: The tree has levels enough for files up to this size unless told otherwise; larger ones stop the job.
LARGEST_FILE = 1 << 60


@functools.lru_cache(maxsize=16)
def file_system(scheme: str, host: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(f"{scheme}://{host}/")[0] if scheme not in ("", "file") else fs.LocalFileSystem()


def opened(path: str) -> pa.NativeFile:
    """Random access to a file named the way Spark names it, that is without escapes."""
    parts = urlsplit(quote(path, safe="/:@%"))
    plain = path.split(":", 1)[1] if parts.scheme else path
    if parts.netloc:
        plain = plain.removeprefix("//").split("/", 1)[1]
        if parts.scheme == "hdfs":
            plain = f"/{plain}"
        else:  # object stores name the bucket first
            plain = f"{parts.netloc}/{plain}"
    elif plain.startswith("//"):
        plain = plain.lstrip("/").join(("/", ""))
    return file_system(parts.scheme, parts.netloc).open_input_file(plain)


def block_digest(path: str, start: int, length: int) -> str:
    digest, left = hashlib.sha256(), length
    with opened(path) as source:
        source.seek(start)
        while left:
            piece = source.read(min(left, PIECE_BYTES))
            if not piece:
                raise OSError(f"{path} ends {left} bytes before the end of the block at {start}")
            digest.update(piece)
            left -= len(piece)
    return digest.hexdigest()


def hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        path, size, block, start, length = batch.columns
        found = [block_digest(*key) for key in zip(path.to_pylist(), start.to_pylist(), length.to_pylist())]
        yield pa.RecordBatch.from_arrays([path, size, block, pa.array(found, pa.string())], ["path", "size_bytes", "block", "sha256"])


def block_digests(
    spark: SparkSession, root: str, pattern: str = "*", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(path, size_bytes, block, sha256), blocks dealt over all tasks; the listing reads no contents."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.col("length").alias("size_bytes"))
    )
    last = F.expr(f"(size_bytes - 1) div {block_bytes}")
    blocks = listed.select("path", "size_bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"))
    start = F.col("block") * block_bytes
    ranges = blocks.select("path", "size_bytes", "block", start.alias("start"), F.least(F.lit(block_bytes), F.col("size_bytes") - start).alias("length"))
    # The rows are tiny and the work is not: a stated number keeps them from being merged into one task.
    tasks = 4 * spark.sparkContext.defaultParallelism
    return ranges.repartition(tasks, "path", "block").mapInArrow(
        hash_blocks, "path string, size_bytes bigint, block bigint, sha256 string"
    )


def joined_digest(order: str) -> Column:
    """Digest of the digests of a group in order; a group of one passes its digest on."""
    in_order = F.array_sort(F.collect_list(F.struct(order, "sha256")))
    return F.when(F.count(F.lit(1)) == 1, F.first("sha256")).otherwise(
        F.sha2(F.array_join(F.transform(in_order, lambda x: x["sha256"]), ""), 256)
    )


def file_digests(
    spark: SparkSession,
    root: str,
    pattern: str = "*",
    block_bytes: int = BLOCK_BYTES,
    fan_out: int = FAN_OUT,
    largest: int = LARGEST_FILE,
) -> DataFrame:
    """(path, size_bytes, sha256) per file: block digests joined ``fan_out`` at a time, level by level, until one is left."""
    nodes, covered = block_digests(spark, root, pattern, block_bytes), block_bytes
    while covered < largest:
        covered *= fan_out
        above = F.expr(f"block div {fan_out}").alias("above")
        nodes = (
            nodes.groupBy("path", "size_bytes", above)
            .agg(joined_digest("block").alias("sha256"))
            .withColumnRenamed("above", "block")
        )
    return nodes.select("path", F.when(F.col("size_bytes") <= covered, F.col("size_bytes")).otherwise(
        F.raise_error(F.concat(F.col("path"), F.lit(f" is larger than {covered} bytes")))
    ).alias("size_bytes"), "sha256")


def set_digest(digests: DataFrame, keys: Sequence[str], size: str = "size_bytes") -> DataFrame:
    """Bytes, number and one digest per key of a set of files, whatever their names, order and number.

    Equal digests are counted first (n copies stand as the digest of "digest:n"); the distinct ones form a tree by their
    first six, three and zero hexadecimal digits, so a group holds about 4,096 of up to 10^10 files.
    """
    copies = digests.groupBy(*keys, "sha256").agg(F.count(F.lit(1)).alias("parts"), F.sum(size).alias(size))
    marked = F.concat_ws(":", "sha256", F.col("parts").cast("string"))
    nodes = copies.select(
        *keys, "parts", size, F.col("sha256").alias("prefix"),
        F.when(F.col("parts") == 1, F.col("sha256")).otherwise(F.sha2(marked, 256)).alias("sha256"),
    )
    for digits in (6, 3, 0):
        nodes = (
            nodes.groupBy(*keys, F.substring("prefix", 1, digits).alias("shorter"))
            .agg(joined_digest("prefix").alias("sha256"), F.sum("parts").alias("parts"), F.sum(size).alias(size))
            .withColumnRenamed("shorter", "prefix")
        )
    return nodes.select(*keys, size, "parts", "sha256")
