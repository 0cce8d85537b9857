"""Sharding by sampled splitters, in DataFrame functions only.

Size-weighted key samples give quantile boundaries; the boundaries cut the keys into many more ranges than shards, and
ranges that turn out overfull are cut again by a denser sample. Byte positions inside a range plus the exact sums of the
ranges before it give every document its exact place, so the shards are as even as whole documents allow and do not
depend on the luck of the sample, which only decides how evenly the work is spread.

The key is (hash of the text, doc_id): equal texts are neighbours and share a shard unless their group is larger than
one fiftieth of a shard; a larger group is cut between documents like any other rows.

Defined cases: null text has size 1 and the checksum of the empty text; repeated rows are placed one by one; null doc_id
is an ordinary key; an empty table gives an empty result; further columns of the input are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import staged

#: Leading bits of the hash that look up the few splitters a key is compared with.
PREFIX_BITS = 10
#: A group of equal texts stays whole while it is at most one WHOLE-th of a shard.
WHOLE = 50


def keyed(docs: DataFrame) -> DataFrame:
    """What placing needs of each document; the text itself is never shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col("text")).alias("hash"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("tie"),
    )


def weighted_sample(keys: DataFrame, rate: float, seed: int) -> DataFrame:
    """Keys drawn with a chance in proportion to their size, each with the bytes it stands for."""
    draw = F.shiftrightunsigned(F.xxhash64("tie", "hash", F.lit(seed)), 11) / F.lit(float(2**53))
    chance = F.col("size") * F.lit(rate)
    return keys.where(draw < chance).withColumn("weight", F.greatest(F.col("size").cast("double"), F.lit(1 / rate)))


def _lookup(values: list, kind: str) -> Column:
    """A list held by the driver as one literal; its length is bounded by the number of ranges."""
    return F.from_json(F.lit(json.dumps(values)), F.lit(kind))


def range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the key; a prefix of the hash leaves few to compare."""
    buckets: list[list[dict]] = [[] for _ in range(1 << PREFIX_BITS)]
    for hash_, tie in splitters:
        buckets[(hash_ >> (64 - PREFIX_BITS)) + (1 << (PREFIX_BITS - 1))].append({"h": hash_, "t": tie})
    below, passed = [], 0
    for bucket in buckets:
        below.append(passed)
        passed += len(bucket)
    prefix = (F.shiftright("hash", 64 - PREFIX_BITS) + (1 << (PREFIX_BITS - 1)) + 1).cast("int")
    near = F.element_at(_lookup(buckets, "array<array<struct<h:bigint,t:bigint>>>"), prefix)
    under = F.filter(
        near, lambda s: (s["h"] < F.col("hash")) | ((s["h"] == F.col("hash")) & (s["t"] <= F.col("tie")))
    )
    return (F.element_at(_lookup(below, "array<int>"), prefix) + F.size(under)).cast("int")


def _settled(splitters: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Boundaries moved to the start of a text's group, except where a group holds several of them."""
    first, out = set(), set()
    for hash_, tie in sorted(splitters):
        if hash_ in first:
            out.add((hash_, tie))
        else:
            first.add(hash_)
            out.add((hash_, -(2**63)))
    return sorted(out)


def splitters_of(keys: DataFrame, total: int, ranges: int, sample: int, rounds: int) -> list[tuple[int, int]]:
    """Boundaries of about `ranges` ranges of equal bytes; overfull ranges are sampled again, up to `rounds` times."""
    step = total / ranges
    found: list[tuple[int, int]] = []
    part, rate = keys.withColumn("range", F.lit(0)), min(1.0, sample / total)
    for n in range(rounds):
        order = Window.partitionBy("range").orderBy("hash", "tie")
        # one row of the sample for every `step` bytes passed inside its range
        cells = weighted_sample(part, rate, n).withColumn(
            "cell", F.floor((F.sum("weight").over(order) - F.col("weight") / 2) / F.lit(step))
        )
        cuts = cells.withColumn("before", F.lag("cell", 1, 0).over(order)).where(F.col("cell") > F.col("before"))
        found = _settled(found + [(r["hash"], r["tie"]) for r in cuts.select("hash", "tie").collect()])
        sums = keys.groupBy(range_of(found).alias("range")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        over = [r["range"] for r in sums.where((F.col("bytes") > 2 * step) & (F.col("n") > 1)).collect()]
        if not over or rate >= 1:
            break
        part = keys.withColumn("range", range_of(found)).where(F.col("range").isin(over))
        rate = min(1.0, rate * 8)
    return found


def place(docs: DataFrame, shards: int = 8, ranges: int | None = None, sample: int = 8192, rounds: int = 3) -> DataFrame:
    """Shard and slot of every document; shards differ by no more than a document or a small group of equal texts.

    `ranges` (at least 8 per shard, otherwise four times the shuffle partitions) bounds what the driver holds and the
    rows that one task sorts; raise it with the data. `sample` is the number of keys drawn.
    """
    spark = docs.sparkSession
    keys = staged(keyed(docs), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = ranges or max(8 * shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = splitters_of(keys, total, ranges, sample, rounds) if total else []
    keys = keys.withColumn("range", range_of(found))
    sums = {r["range"]: r for r in keys.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    bytes_before, rows_before, b, n = [], [], 0, 0
    for k in range(len(found) + 1):
        bytes_before.append(b)
        rows_before.append(n)
        if k in sums:
            b, n = b + sums[k]["b"], n + sums[k]["n"]

    order = Window.partitionBy("range").orderBy("hash", "tie", "size", "text_crc32")
    at = F.col("range") + 1
    group = Window.partitionBy("range", "hash")
    placed = (
        keys.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("row", F.row_number().over(order) - 1 + F.element_at(_lookup(rows_before, "array<bigint>"), at))
        .withColumn("end", F.col("end") + F.element_at(_lookup(bytes_before, "array<bigint>"), at))
        .withColumn("group_end", F.max("end").over(group))
        .withColumn("group_size", F.sum("size").over(group))
    )
    whole = F.col("group_size") * (WHOLE * shards) <= F.lit(total)
    twice_middle = F.when(whole, 2 * F.col("group_end") - F.col("group_size")).otherwise(2 * F.col("end") - F.col("size"))
    shard = F.least(F.lit(shards - 1), F.floor(twice_middle * F.lit(shards) / F.lit(max(1, 2 * total)))).cast("int")
    placed = staged(placed.select("doc_id", "size", "text_crc32", "row", shard.alias("shard")), "shard-rows")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
