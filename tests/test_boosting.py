"""Boosted trees, their attribution and the halving search."""

from __future__ import annotations

import itertools
import math
import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from demandloom.operators import boosting, learned
from demandloom.operators.boosting import Booster, BoostedModel, Loss
from demandloom.operators.trees import Ensemble, FlatTree

NAMES = [f"x{k}" for k in range(5)]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Counts whose mean depends on two features and one interaction; about half are zero."""
    rng = np.random.default_rng(7)
    x = rng.random((3000, 5)).round(3) * 10
    mean = np.exp(x[:, 0] / 5 - 1 + (x[:, 1] > 5) * (x[:, 2] > 3))
    y = rng.poisson(mean).astype(float)
    data = [(n, *map(float, r), t) for n, (r, t) in enumerate(zip(x.tolist(), y.tolist(), strict=True))]
    frame = spark.createDataFrame(data, ["row_key", *NAMES, "target"])
    path = str(tmp_path_factory.mktemp("boost"))
    VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame).write.parquet(f"{path}/rows")
    return spark.read.parquet(f"{path}/rows")


LOSSES = [Loss("tweedie", 1.2), Loss("tweedie", 1.0), Loss("quantile", level=0.5), Loss("quantile", level=0.9), Loss("huber"), Loss("squared")]


@pytest.fixture(scope="module")
def fitted(rows):
    return {loss: Booster(loss, rounds=4, depth=3, step=0.5).fit(rows) for loss in LOSSES}


@pytest.mark.parametrize("loss", LOSSES, ids=str)
def test_training_loss_never_rises(rows, fitted, loss):
    model = fitted[loss]
    assert len(model.losses) == 5
    assert all(b <= a + 1e-12 for a, b in itertools.pairwise(model.losses)) and model.losses[-1] < model.losses[0]
    # the losses reported are those of the forecasts
    score = model.ensemble.score_column()
    assert rows.agg(F.avg(loss.value(F.col("target"), score))).first()[0] == pytest.approx(model.losses[-1], rel=1e-9)


def test_forecasts_are_of_their_kind(rows, fitted):
    both = fitted[LOSSES[0]].transform(rows).select("*", F.col("_raw").alias("tweedie")).drop("_raw")
    both = fitted[LOSSES[3]].transform(both).agg(
        F.avg("tweedie"), F.avg("target"), F.avg((F.col("target") <= F.col("_raw")).cast("double")), F.min("tweedie"),
        F.corr("tweedie", "target"),
    ).first()
    assert abs(both[0] / both[1] - 1) < 0.1 and both[3] > 0 and both[4] > 0.5
    assert 0.85 < both[2] < 0.97  # the 0.9 quantile covers nine in ten


def test_leaf_step_is_the_minimum(rows):
    """Against a scan over steps, for every leaf of a tree of two leaves."""
    for loss in LOSSES:
        leafed = rows.select("features", "target", F.lit(0.3).alias("score"), (F.col("row_key") % 2).cast("int").alias("leaf"))
        values, covers, before = loss.leaf_values(leafed, 3, ridge=0.0)
        assert covers == [1500.0, 1500.0, 0.0] and values[2] == 0.0
        at = [rows.sparkSession.createDataFrame([(v,) for v in np.linspace(values[0] - 0.5, values[0] + 0.5, 11).tolist()], "v double")]
        scan = leafed.where("leaf = 0").crossJoin(at[0]).groupBy("v").agg(F.avg(loss.value(F.col("target"), F.col("score") + F.col("v"))).alias("l"))
        found = {r["v"]: r["l"] for r in scan.collect()}
        best = min(found, key=found.get)
        if loss.kind != "huber":  # one bounded step towards the minimum
            assert best == pytest.approx(values[0], abs=0.11)
        assert found[min(found, key=lambda v: abs(v - values[0]))] <= loss_at_zero(leafed, loss) + 1e-12


def loss_at_zero(leafed, loss):
    return leafed.where("leaf = 0").agg(F.avg(loss.value(F.col("target"), F.col("score")))).first()[0]


def test_flat_tree_equals_the_model(rows):
    model = DecisionTreeRegressor(labelCol="target", maxDepth=6, maxBins=16).fit(rows)
    flat = FlatTree.parse(model.toDebugString)
    scored = model.setLeafCol("leaf").transform(rows).select(*NAMES, "prediction", "leaf").toPandas()
    x = scored[NAMES].to_numpy()
    assert np.array_equal(flat.score(x), scored["prediction"].to_numpy())
    assert np.array_equal(np.searchsorted(flat.leaves, flat.leaf_of(x)), scored["leaf"].to_numpy().astype(int))


def expected(tree, x, known, node=0):
    """Score of a row of which only some features are known; covers decide at the others."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return expected(tree, x, known, left if x[f] <= tree.threshold[node] else right)
    return sum(tree.cover[c] / tree.cover[node] * expected(tree, x, known, c) for c in (left, right))


def all_subsets(ensemble, x):
    d = len(x)
    out = np.zeros(d)
    for k in range(d):
        others = [j for j in range(d) if j != k]
        for size in range(d):
            weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
            for chosen in itertools.combinations(others, size):
                for tree in ensemble.trees:
                    out[k] += weight * (expected(tree, x, {*chosen, k}) - expected(tree, x, set(chosen)))
    return out


def test_attribution_equals_all_subsets(rows, fitted):
    ensemble = fitted[LOSSES[0]].ensemble
    x = np.array([list(r) for r in rows.select(*NAMES).limit(12).collect()])
    values = ensemble.attribution().values(x)
    for row, got in zip(x, values, strict=True):
        assert got == pytest.approx(all_subsets(ensemble, row), abs=1e-12)
    assert ensemble.base_value() + values.sum(axis=1) == pytest.approx(ensemble.score(x), abs=1e-12)


def test_attribution_columns_add_up(rows, fitted):
    told = fitted[LOSSES[0]].explain(rows, NAMES, "shap_")
    total = sum((F.col(f"shap_{c}") for c in NAMES), F.col("base_value"))
    assert told.agg(F.max(F.abs(total - F.col("model_output")))).first()[0] < 1e-9
    means = told.agg(*[F.avg(F.abs(f"shap_{c}")) for c in NAMES]).first()
    assert min(means[0], means[1]) > max(means[3], means[4])  # the features without influence come last


def test_stored_trees_score_alike(spark, rows, fitted, tmp_path):
    for loss in (LOSSES[0], LOSSES[2]):
        fitted[loss].table(spark).write.parquet(f"{tmp_path}/{loss.kind}")
        again = BoostedModel.of_table(spark.read.parquet(f"{tmp_path}/{loss.kind}"))
        assert again.log_link == loss.log_link
        x = np.random.default_rng(1).random((50, 5)) * 10
        assert np.array_equal(again.ensemble.score(x), fitted[loss].ensemble.score(x))


def test_constant_and_empty_rows(spark, rows):
    none = rows.limit(0)
    for loss in LOSSES:
        assert loss.start(none) == (0.0)
    zero = rows.limit(200).withColumn("target", F.lit(0.0))
    model = Booster(Loss("tweedie", 1.2), rounds=2, depth=2).fit(zero)
    assert model.transform(zero).agg(F.max("_raw")).first()[0] < 1e-6
    with pytest.raises(ValueError):
        Loss("tweedie", 2.5)
    with pytest.raises(ValueError):
        Loss("other")
    assert Ensemble(1.5).score(np.zeros((2, 3))).tolist() == [1.5, 1.5]


# -- search -----------------------------------------------------------------------------------------------------------


def test_rungs_and_draws():
    assert learned.rungs(9, 3, 0.9) == [(9, pytest.approx(0.1)), (3, pytest.approx(0.3)), (1, 0.9)]
    assert learned.rungs(1, 2, 0.5) == [(1, 0.5)]
    with pytest.raises(ValueError):
        learned.rungs(4, 1, 0.5)
    many = learned.drawn_candidates(learned.TREE_SPACE, 200, 1)
    assert many[:5] == learned.drawn_candidates(learned.TREE_SPACE, 5, 1) and len({tuple(c.items()) for c in many}) == 200
    for name, span in learned.TREE_SPACE.items():
        values = [c[name] for c in many]
        assert min(values) >= span.low and max(values) <= span.high
        assert not span.whole or {*values} == {*range(int(span.low), int(span.high) + 1)}


def test_halving_keeps_the_best(spark, panel, small):
    from demandloom.operators.features import build_direct_features

    daily, days = panel
    train = build_direct_features(daily, days, small).where("origin_day < 54 AND origin_day + horizon <= 54")
    space = {"rounds": learned.Span(1, 3, whole=True), "depth": learned.Span(1, 2, whole=True), "step": learned.Span(0.1, 0.9)}
    best, table = learned.halving_search(train, "tweedie_trees", 4, 5, keep=2, space=space)
    found = table.collect()
    by_rung = {k: [r for r in found if r["rung"] == k] for k in {r["rung"] for r in found}}
    assert [len(by_rung[k]) for k in sorted(by_rung)] == [4, 2, 1]
    for k, group in by_rung.items():
        kept = [r["wape"] for r in group if r["kept"]]
        assert max(kept) <= min([r["wape"] for r in group if not r["kept"]], default=math.inf)
        assert {r["candidate"] for r in group if r["kept"]} == {r["candidate"] for r in by_rung.get(k + 1, group) if k + 1 in by_rung or r["kept"]}
    sizes = [by_rung[k][0]["fit_rows"] for k in sorted(by_rung)]
    assert sizes == sorted(sizes) and sizes[0] < sizes[-1]
    assert {k: str(v) for k, v in best.items()} == by_rung[2][0]["parameters"]


def test_errors_of_blend_and_cuts(spark):
    """Known answers: a forecast twice too high is halved, and small forecasts of nothing are cut."""
    rows = [(4.0, 7.0)] * 50 + [(0.0, 0.9)] * 30
    frame = spark.createDataFrame(rows, "target double, yhat double")
    scale, raw, bias, fair, fair_bias, threshold, cut_scale, cut, cut_bias = learned.adjusted_errors(frame, frame)
    assert raw == pytest.approx((150 + 27) / 200) and bias == pytest.approx(raw)
    assert scale == pytest.approx(0.55) and abs(fair_bias) <= 0.05 and fair == pytest.approx((7.5 + 14.85) / 200)
    assert threshold == pytest.approx(1.0) and cut_scale == pytest.approx(0.6)
    assert cut == pytest.approx(0.05) and cut_bias == pytest.approx(0.05)


def test_fits_of_a_search_run_side_by_side(spark, panel, small, monkeypatch):
    from demandloom.operators.features import build_direct_features

    daily, days = panel
    train = build_direct_features(daily, days, small).where("origin_day < 54 AND origin_day + horizon <= 54")
    plain = learned.DirectForecaster.fit_model
    lock, under_way, most = threading.Lock(), [], []

    def watched(self, frame):
        with lock:
            under_way.append(1)
            most.append(len(under_way))
        try:
            return plain(self, frame)
        finally:
            with lock:
                under_way.pop()

    monkeypatch.setattr(learned.DirectForecaster, "fit_model", watched)
    space = {"rounds": learned.Span(1, 1, whole=True), "depth": learned.Span(1, 2, whole=True)}
    together = learned.halving_search(train, "tweedie_trees", 2, 5, keep=2, space=space)
    assert max(most) == 2
    monkeypatch.setattr(learned, "FITS_AT_ONCE", 1)
    most.clear()
    alone = learned.halving_search(train, "tweedie_trees", 2, 5, keep=2, space=space)
    assert max(most) == 1 and together[0] == alone[0]
    assert sorted(map(str, together[1].collect())) == sorted(map(str, alone[1].collect()))
