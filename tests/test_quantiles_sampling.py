from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import sampling
from demandloom.operators.quantiles import exact_quantiles, exact_quantiles_by_weight


def make(spark, seed=3):
    rng = random.Random(seed)
    data = [("hot", rng.gauss(0, 100)) for _ in range(3000)]
    data += [("ties", float(rng.choice([0, 0, 0, 1, 5]))) for _ in range(900)]
    data += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("nulls", None), ("nulls", 4.0)]
    return data, spark.createDataFrame(data, "g string, v double").repartition(7)


@pytest.mark.parametrize("discrete", [False, True])
def test_exact_quantiles_match_numpy(spark, discrete):
    data, frame = make(spark)
    levels = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r["g"]: r for r in exact_quantiles(frame, ["g"], "v", levels, discrete=discrete).collect()}
    for g in {x for x, _ in data}:
        values = np.array([v for x, v in data if x == g and v is not None])
        for name, p in levels.items():
            method = "inverted_cdf" if discrete else "linear"
            assert got[g][name] == pytest.approx(np.quantile(values, p, method=method), abs=1e-9), (g, name)


def test_exact_quantiles_without_groups_and_with_weights(spark):
    frame = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 4)], "v double, w int")
    row = exact_quantiles(frame, [], "v", {"m": 0.5, "h": 0.6}, weight="w").first()
    values = np.repeat([1.0, 2.0, 10.0], [3, 1, 4])
    assert row["m"] == pytest.approx(np.quantile(values, 0.5)) and row["h"] == pytest.approx(np.quantile(values, 0.6))


def test_row_numbers_equal_one_global_order(spark):
    frame = spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "IF(id % 3 = 0, 'x', 'y') AS g").repartition(5)
    got = sampling.enumerate_rows(frame, ["k"], ["g"], 42)
    by_group = {}
    for r in got.collect():
        by_group.setdefault(r["g"], []).append((r["row_index"], r["k"], r["group_rows"]))
    import hashlib

    for g, found in by_group.items():
        assert sorted(i for i, _, _ in found) == list(range(len(found))) and {n for _, _, n in found} == {len(found)}
        expected = sorted((hashlib.md5(f"{k}:42".encode()).hexdigest(), k) for _, k, _ in found)
        assert [k for _, k, _ in sorted(found)] == [k for _, k in expected]


def test_stratified_sample_is_exact_and_stable(spark):
    frame = spark.range(2000).selectExpr("CAST(id AS STRING) AS id", "IF(id < 1500, 'CA', 'TX') AS state_id")
    once = sampling.stratified_series(frame, "id", "state_id", 25, 42)
    again = sampling.stratified_series(frame.repartition(9), "id", "state_id", 25, 42)
    assert {r["id"] for r in once.collect()} == {r["id"] for r in again.collect()}
    assert {r["state_id"]: r["count"] for r in once.groupBy("state_id").count().collect()} == {"CA": 25, "TX": 25}


def test_fraction_and_fixed_samples_do_not_depend_on_partitioning(spark):
    frame = spark.range(4000).withColumn("k", F.col("id") % 50)
    a = {r["id"] for r in sampling.sample_fraction(frame, ["id"], 0.1, 1).collect()}
    b = {r["id"] for r in sampling.sample_fraction(frame.repartition(3), ["id"], 0.1, 1).collect()}
    assert a == b and 300 < len(a) < 500
    c = {r["id"] for r in sampling.sample_rows(frame, ["id"], 100, 1).collect()}
    assert len(c) == 100 and c == {r["id"] for r in sampling.sample_rows(frame.repartition(6), ["id"], 100, 1).collect()}


@pytest.mark.parametrize("discrete", [True, False])
def test_several_weights_share_a_pass_and_equal_copies_of_rows(spark, discrete):
    generator = random.Random(5)
    rows = [(g, round(generator.gauss(0, 3), 1), generator.randrange(3), int(g == "b"), 0) for g in "ab" for _ in range(900)]
    frame = spark.createDataFrame([*rows, ("a", None, 9, 9, 9)], "g string, v double, w1 int, w2 int, w3 int")
    levels = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    weights = {10: "w1", 20: "w2", 30: "w3"}
    got = exact_quantiles_by_weight(frame, ["g"], "v", levels, weights, "fold", discrete=discrete).collect()
    expected = {}
    for k, fold in enumerate(weights):
        for g in "ab":
            copied = np.repeat([r[1] for r in rows if r[0] == g], [r[2 + k] for r in rows if r[0] == g])
            if len(copied):
                method = "inverted_cdf" if discrete else "linear"
                expected[g, fold] = [float(np.quantile(copied, q, method=method)) for q in levels.values()]
    assert {(r["g"], r["fold"]) for r in got} == set(expected) and len(got) == 3
    for r in got:
        assert [r[q] for q in levels] == pytest.approx(expected[r["g"], r["fold"]])


@pytest.mark.parametrize("discrete", [True, False])
def test_quantiles_of_many_distinct_values_do_not_depend_on_the_merge_order(spark, discrete):
    # more distinct values than an approximate percentile tells apart, in partitions of mixed order
    value = F.pmod(F.xxhash64("id"), F.lit(100_003)).cast("double")
    frame = spark.range(0, 400_000, 1, 13).select(value.alias("v"), F.lit(1).alias("w1"), (F.col("id") % 3).cast("int").alias("w2"))
    levels = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    data = frame.toPandas()
    method = "inverted_cdf" if discrete else "linear"
    got = exact_quantiles_by_weight(frame, [], "v", levels, {1: "w1", 2: "w2"}, "k", discrete=discrete).collect()
    assert len(got) == 2
    for r in got:
        copied = np.repeat(data["v"].to_numpy(), data[f"w{r['k']}"].to_numpy())
        assert [r[q] for q in levels] == pytest.approx([float(np.quantile(copied, q, method=method)) for q in levels.values()])
