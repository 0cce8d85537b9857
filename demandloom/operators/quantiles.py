"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = 64
#: Values per group, at most, that place the cuts between slices.
DRAWN = 2048


def exact_quantiles(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: dict[str, float],
    weight: str | None = None,
    discrete: bool = False,
) -> DataFrame:
    """Exact quantiles per group, one output column per entry of ``levels``.

    ``discrete`` returns the smallest observed value whose cumulative share
    reaches the level; otherwise neighbours are interpolated linearly.

    The built-in exact percentile keeps every distinct value of a group in one
    task. Here values are first collapsed to (group, value, count) with map-side
    combination (one shuffle, which the passes that follow share), cut into slices
    of about equal numbers of distinct values, and only the slices that contain a
    wanted rank are ordered. A group may hold any share of the rows. Nothing runs
    before the result is asked for, and no join is told to broadcast: the size of
    the per-group tables decides. The plan cuts the values twice, so the cuts depend
    on the values alone, never on the order in which tasks are merged.
    """
    copies = F.count(F.lit(1)) if weight is None else F.sum(weight)
    found = _quantiles(_tallied(frame, keys, value, [copies]), list(keys), levels, 1, discrete)
    return found.select(*keys, *[F.col(f"_q0_{name}").alias(name) for name in levels])


def exact_quantiles_by_weight(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: dict[str, float],
    weights: Mapping[object, str],
    label: str,
    discrete: bool = False,
) -> DataFrame:
    """Quantiles of the same values under several weights, one row per group and weight that has rows.

    ``weights`` maps what stands in the ``label`` column to a column of whole numbers. The rows are neither copied nor
    ordered once per weight: running sums of all weights share one ordered pass.
    """
    tallied = _tallied(frame, keys, value, [F.sum(w) for w in weights.values()])
    found = _quantiles(tallied, list(keys), levels, len(weights), discrete)
    rows = [
        F.struct(F.lit(name).alias(label), *[F.col(f"_q{k}_{level}").alias(level) for level in levels])
        for k, name in enumerate(weights)
    ]
    return found.select(*keys, F.inline(F.array(*rows))).where(F.col(next(iter(levels))).isNotNull())


def _tallied(frame: DataFrame, keys: Sequence[str], value: str, counts: Sequence[Column]) -> DataFrame:
    """(group, value, counts): one row per distinct value, with map-side combination."""
    return (
        frame.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(*[c.cast("bigint").alias(f"_n{k}") for k, c in enumerate(counts)])
    )


def _quantiles(tallied: DataFrame, keys: list[str], levels: dict[str, float], counts: int, discrete: bool) -> DataFrame:
    """One row per group; column ``_q{k}_{level}`` holds the quantile under count k, null if it has no rows."""
    n, total, start = ([f"{name}{k}" for k in range(counts)] for name in ("_n", "_total", "_start"))
    # The value of the lowest hash in each of DRAWN hash buckets: spread like the values, and the same in every run.
    digest = F.xxhash64("_v")
    buckets = tallied.groupBy(*keys, F.pmod(digest, F.lit(DRAWN)).alias("_bucket")).agg(
        F.min(F.struct(digest.alias("_digest"), "_v")).alias("_first"), *[F.sum(a).alias(a) for a in n]
    )
    drawn = F.sort_array(F.collect_list("_first._v"))
    cuts = buckets.groupBy(*keys).agg(drawn.alias("_drawn"), *[F.sum(a).alias(t) for a, t in zip(n, total)])
    at = F.array(*[F.lit(i) for i in range(1, SPLITS)])
    cut = F.transform(at, lambda i: F.get("_drawn", F.floor(i * F.size("_drawn") / SPLITS).cast("int")))
    sliced = _attach(tallied, cuts.select(*keys, cut.alias("_cuts"), *total), keys).select(
        *keys, "_v", *n, *total, F.size(F.filter("_cuts", lambda c: c <= F.col("_v"))).alias("_slice")
    )
    # At most SPLITS rows per group from here on, until the slices are revisited.
    sizes = sliced.groupBy(*keys, "_slice").agg(*[F.sum(a).alias(a) for a in n], *[F.max(t).alias(t) for t in total])
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bounds = sizes.select("*", *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(s) for a, s in zip(n, start)])
    wants = F.array(*[_ranks(k, name, level, discrete) for k in range(counts) for name, level in levels.items()])
    ends = F.array(*[F.col(s) + F.col(a) for s, a in zip(start, n)])
    here = F.filter(wants, lambda w: _meets(w, F.array(*start), ends))
    located = bounds.select(*keys, "_slice", *start, here.alias("_wants")).where(F.size("_wants") > 0)
    inside = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        sliced.join(located, [*keys, "_slice"])
        .withColumn("_to", F.array(*[F.col(s) + F.sum(a).over(inside) for s, a in zip(start, n)]))
        .withColumn("_from", F.zip_with("_to", F.array(*n), lambda end, count: end - count))
    )
    hit = F.filter("_wants", lambda w: _meets(w, F.col("_from"), F.col("_to")))
    hits = placed.select(*keys, "_v", "_from", "_to", F.explode(hit).alias("_want"))
    columns = []
    for k in range(counts):
        for name in levels:
            mine = (F.col("_want._count") == k) & (F.col("_want._name") == name)
            low = F.max(F.when(mine & _holds("_low"), F.col("_v")))
            high = F.max(F.when(mine & _holds("_high"), F.col("_v")))
            share = F.max(F.when(mine, F.col("_want._fraction")))
            columns.append((low + (high - low) * share).alias(f"_q{k}_{name}"))
    return hits.groupBy(*keys).agg(*columns)


def _attach(left: DataFrame, per_group: DataFrame, keys: list[str]) -> DataFrame:
    """Join with a table of one row per group."""
    # Without keys there is one row.
    return left.join(per_group, keys) if keys else left.crossJoin(F.broadcast(per_group))


def _meets(want: Column, starts: Column, ends: Column) -> Column:
    """Whether one of the two wanted ranks lies in [start, end) of its count."""
    low, high = want["_low"], want["_high"]
    start, end = F.get(starts, want["_count"]), F.get(ends, want["_count"])
    return ((low >= start) & (low < end)) | ((high >= start) & (high < end))


def _holds(rank: str) -> Column:
    wanted = F.col("_want")[rank]
    own = F.col("_want._count")
    return (wanted >= F.get("_from", own)) & (wanted < F.get("_to", own))


def _ranks(count: int, name: str, level: float, discrete: bool) -> Column:
    if discrete:
        low = F.greatest(F.ceil(F.lit(level) * F.col(f"_total{count}")) - 1, F.lit(0))
        high, fraction = low, F.lit(0.0)
    else:
        position = F.lit(level) * (F.col(f"_total{count}") - 1)
        low = F.floor(position)
        high, fraction = F.ceil(position), position - low
    return F.struct(
        F.lit(count).alias("_count"),
        F.lit(name).alias("_name"),
        low.cast("bigint").alias("_low"),
        high.cast("bigint").alias("_high"),
        fraction.cast("double").alias("_fraction"),
    )
