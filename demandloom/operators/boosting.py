"""Gradient boosting for count and quantile losses, with Spark ML regression trees.

Each round fits one weighted regression tree to what the loss asks for at the current scores (for losses with a log link
the Newton step, weighted by the curvature), then throws the tree's own leaf values away: one aggregate per round gives
every leaf the value that lowers the loss most. Leaf values come from all rows even where the splits saw a sample, and a
step is at most the whole way to the minimum of a convex loss, so the training loss cannot rise from round to round.

Rows stay distributed: the driver receives one row per leaf. The rows with their current scores are kept next to the tasks,
in memory or on disk, and written every few rounds, so neither plans nor recomputation after a loss grow with the rounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import clamp, pinball
from demandloom.operators.quantiles import exact_quantiles
from demandloom.operators.trees import Ensemble, FlatTree
from demandloom.sources.tables import dropped, staged

#: Bounds of a log-link score and of one leaf's step on that scale.
SCORE_LIMIT, STEP_LIMIT = 20.0, 5.0
#: Accuracy of the tally of a leaf's misses: its quantile is off by at most this part of the leaf's rows.
TALLY = 10_000
#: Rounds between two writes of the scores.
WRITTEN_EVERY = 6


@dataclass(frozen=True)
class Loss:
    """``tweedie`` (power 1 is Poisson), ``quantile`` (level 0.5 is the absolute error), ``huber`` or ``squared``."""

    kind: str
    power: float = 1.2
    level: float = 0.5
    delta: float = 1.0

    def __post_init__(self):
        if self.kind not in ("tweedie", "quantile", "huber", "squared"):
            raise ValueError(f"unknown loss {self.kind!r}")
        if self.kind == "tweedie" and not 1 <= self.power < 2:
            raise ValueError("the variance power must lie in [1, 2)")
        if self.kind == "quantile" and not 0 < self.level < 1:
            raise ValueError("the level must lie strictly between zero and one")

    @property
    def log_link(self) -> bool:
        return self.kind == "tweedie"

    def _parts(self, y: Column, score: Column) -> tuple[Column, Column]:
        """The two terms whose difference is the slope of a Tweedie loss."""
        return y * F.exp((1.0 - self.power) * score), F.exp((2.0 - self.power) * score)

    def value(self, y: Column, score: Column) -> Column:
        """Loss of a row, up to what does not depend on the score."""
        miss = y - score
        if self.kind == "tweedie":
            low, high = self._parts(y, score)
            first = y * score if self.power == 1 else low / (1.0 - self.power)
            return high / (2.0 - self.power) - first
        if self.kind == "quantile":
            return pinball(y, score, self.level)
        if self.kind == "huber":
            size = F.abs(miss)
            return F.when(size <= self.delta, miss * miss / 2).otherwise(self.delta * (size - self.delta / 2))
        return miss * miss / 2

    def wanted(self, y: Column, score: Column) -> tuple[Column, Column]:
        """What a tree is fitted to, and the weight of the row."""
        miss, one = y - score, F.lit(1.0)
        if self.kind == "tweedie":
            low, high = self._parts(y, score)
            curvature = (self.power - 1.0) * low + (2.0 - self.power) * high
            return (low - high) / curvature, curvature
        if self.kind == "quantile":
            return F.when(miss > 0, self.level).when(miss < 0, self.level - 1.0).otherwise(0.0), one
        return (clamp(miss, -self.delta, self.delta) if self.kind == "huber" else miss), one

    def start(self, rows: DataFrame) -> float:
        """Best constant score."""
        if self.kind == "quantile":
            found = exact_quantiles(rows, [], "target", {"v": self.level}, discrete=True).first()
            return float(found["v"]) if found is not None and found["v"] is not None else 0.0
        mean = rows.agg(F.avg("target")).first()[0]
        if mean is None:
            return 0.0
        if not self.log_link:
            return float(mean)
        return min(max(math.log(mean), -SCORE_LIMIT), SCORE_LIMIT) if mean > 0 else -SCORE_LIMIT

    def leaf_values(self, leafed: DataFrame, leaves: int, ridge: float) -> tuple[list[float], list[float], float]:
        """Per leaf the step that lowers the loss most (drawn to zero by ``ridge`` rows) and its rows; the loss before it."""
        y, score = F.col("target"), F.col("score")
        sums = [F.count(F.lit(1)).alias("rows"), F.sum(self.value(y, score)).alias("loss")]
        if self.kind == "tweedie":
            low, high = self._parts(y, score)
            sums += [F.sum(low).alias("low"), F.sum(high).alias("high")]
        elif self.kind == "quantile":
            # a mergeable tally of bounded size; exact while a leaf has fewer distinct values than its accuracy
            sums.append(F.percentile_approx(y - score, self.level, TALLY).alias("shift"))
        else:
            sums.append(F.sum(self.wanted(y, score)[0]).alias("pull"))
        found = {int(r["leaf"]): r for r in leafed.groupBy("leaf").agg(*sums).collect()}
        values = []
        for leaf in range(leaves):
            r = found.get(leaf)
            if r is None:
                values.append(0.0)
            elif self.kind == "tweedie":
                # both sums get as many rows of the leaf's own mean curvature, so that no sale at all stays finite
                extra = ridge * max(r["high"] / r["rows"], 1e-9)
                step = math.log(max(r["low"] + extra, 1e-300) / (r["high"] + extra))
                values.append(min(max(step, -STEP_LIMIT), STEP_LIMIT))
            elif self.kind == "quantile":
                values.append(float(r["shift"]))
            else:
                values.append(float(r["pull"]) / (r["rows"] + ridge))
        rows = [float(found[leaf]["rows"]) if leaf in found else 0.0 for leaf in range(leaves)]
        total = sum(rows)
        return values, rows, sum(r["loss"] for r in found.values()) / total if total else 0.0


@dataclass
class Booster:
    """Settings of a fit; the names are those of the usual tuning parameters."""

    loss: Loss
    rounds: int = 30
    step: float = 0.2
    depth: int = 5
    leaf_rows: int = 20
    subsample: float = 0.8
    colsample: float = 0.8
    ridge: float = 1.0
    bins: int = 32
    seed: int = 42

    def fit(self, rows: DataFrame) -> BoostedModel:
        """Fit to columns features (vector), target and row_key (a number that tells rows apart)."""
        start = self.loss.start(rows)
        spread = rows.sparkSession.sparkContext.defaultParallelism
        rows = rows.select("features", "target", "row_key", F.lit(start).alias("score"))
        state = written = staged(rows.repartition(spread) if rows.rdd.getNumPartitions() < spread else rows, "boost")
        state.persist()
        ensemble, losses = Ensemble(start), []
        for round_ in range(self.rounds):
            wanted, weight = self.loss.wanted(F.col("target"), F.col("score"))
            seen = state
            if self.subsample < 1:
                share = F.pmod(F.xxhash64("row_key", F.lit(self.seed), F.lit(round_)), F.lit(1_000_000))
                seen = state.where(share < int(self.subsample * 1_000_000))
            forest = RandomForestRegressor(
                numTrees=1, bootstrap=False, maxDepth=self.depth, maxBins=self.bins, minInstancesPerNode=self.leaf_rows,
                featureSubsetStrategy="all" if self.colsample >= 1 else str(self.colsample), seed=self.seed + round_,
                labelCol="wanted", weightCol="weight",
            )
            tree = forest.fit(seen.select("features", wanted.alias("wanted"), weight.alias("weight"))).trees[0]
            flat = FlatTree.parse(tree.toDebugString)
            leafed = tree.setLeafCol("_leaf").setPredictionCol("_own").transform(state)
            leafed = leafed.select("features", "target", "row_key", "score", F.col("_leaf").cast("int").alias("leaf"))
            values, covers, loss = self.loss.leaf_values(leafed, len(flat.leaves), self.ridge)
            if not losses:
                losses.append(loss)
            values = [self.step * v for v in values]
            ensemble.trees.append(flat.with_leaves(values, covers))
            moved = F.col("score") + F.element_at(F.array(*[F.lit(v) for v in values]), F.col("leaf") + 1)
            if self.loss.log_link:
                moved = clamp(moved, -SCORE_LIMIT, SCORE_LIMIT)
            after = leafed.select("features", "target", "row_key", moved.alias("score"))
            if (round_ + 1) % WRITTEN_EVERY == 0:
                after = staged(after, "boost")
                dropped(written)
                written = after
            # the sum fills the new store while the old one is still there
            after.persist()
            losses.append(after.agg(F.avg(self.loss.value(F.col("target"), F.col("score")))).first()[0])
            state.unpersist()
            state = after
        state.unpersist()
        dropped(written)
        return BoostedModel(ensemble, self.loss.log_link, [float(v or 0.0) for v in losses])


@dataclass
class BoostedModel:
    """Fitted trees; ``losses`` are the mean training losses before each round and after the last."""

    ensemble: Ensemble
    log_link: bool
    losses: list[float] = field(default_factory=list)

    def transform(self, frame: DataFrame) -> DataFrame:
        """The frame with the forecast (_raw) of its feature vectors."""
        score = self.ensemble.score_column()
        if self.log_link:
            score = F.exp(clamp(score, -SCORE_LIMIT, SCORE_LIMIT))
        return frame.withColumn("_raw", score)

    def explain(self, frame: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
        """Shapley values on the scale of the scores (logarithms for a log link)."""
        return self.ensemble.attributed(frame, names, prefix)

    def table(self, spark) -> DataFrame:
        return self.ensemble.table(spark).withColumn("log_link", F.lit(self.log_link))

    @classmethod
    def of_table(cls, nodes: DataFrame) -> BoostedModel:
        return cls(Ensemble.of_table(nodes), bool(nodes.select("log_link").first()[0]))
