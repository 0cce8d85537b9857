"""Deterministic samples and distributed row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import hash_number, text_hash

SALT_BUCKETS = 64


def stratified_series(frame: DataFrame, id_column: str, stratum: str, per_stratum: int, seed: int) -> DataFrame:
    """Keep the ``per_stratum`` ids with the lowest seeded hash in each stratum, whole rows only.

    Ranked in two steps: first inside hash-made slices of a stratum, then among
    the slice winners, so no task ever sorts a whole stratum.
    """
    digest = text_hash(F.col(id_column), F.lit(seed))
    tagged = frame.withColumns({"_digest": digest, "_slice": hash_number(digest) % SALT_BUCKETS})
    by_hash = [F.col("_digest"), F.col(id_column)]
    in_slice = Window.partitionBy(stratum, "_slice").orderBy(*by_hash)
    in_stratum = Window.partitionBy(stratum).orderBy(*by_hash)
    finalists = tagged.withColumn("_place", F.row_number().over(in_slice)).where(F.col("_place") <= per_stratum)
    return (
        finalists.withColumn("_place", F.row_number().over(in_stratum))
        .where(F.col("_place") <= per_stratum)
        .drop("_digest", "_slice", "_place")
    )


def sample_fraction(frame: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Row sample decided by a hash of the key, hence the same under any partitioning."""
    share = hash_number(text_hash(*[F.col(k) for k in keys], F.lit(seed))) / F.lit(float(2**32))
    return frame.where(share < fraction)


def sample_rows(frame: DataFrame, keys: Sequence[str], size: int, seed: int) -> DataFrame:
    """Fixed-size row sample: the ``size`` lowest key hashes (a top-k, never a full sort)."""
    digest = text_hash(*[F.col(k) for k in keys], F.lit(seed))
    return frame.withColumn("_digest", digest).orderBy("_digest", *keys).limit(size).drop("_digest")


def enumerate_rows(frame: DataFrame, keys: Sequence[str], within: Sequence[str], seed: int) -> DataFrame:
    """Number the rows of each ``within`` group from 0 in seeded hash order.

    Equals a row number over the whole group, but is computed from 4096 hash
    prefixes: rows are ranked inside their prefix and shifted by the number of
    rows with a smaller prefix. Prefixes are even by construction, so a group
    holding most rows is still spread over all tasks.
    """
    tagged = frame.withColumn("_digest", text_hash(*[F.col(k) for k in keys], F.lit(seed))).withColumn(
        "_prefix", F.substring("_digest", 1, 3)
    )
    counted = tagged.groupBy(*within, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*within).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*within)
    shifts = counted.select(
        *within,
        "_prefix",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"),
        F.sum("_rows").over(whole).alias("group_rows"),
    )
    local = Window.partitionBy(*within, "_prefix").orderBy("_digest", *keys)
    return (
        tagged.withColumn("_local", F.row_number().over(local) - 1)
        .join(shifts, [*within, "_prefix"])
        .withColumn("row_index", F.col("_shift") + F.col("_local"))
        .drop("_digest", "_prefix", "_local", "_shift")
    )
