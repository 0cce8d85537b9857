"""Regression trees as flat node arrays: scoring and exact attribution in Arrow batches.

A tree is walked for all rows of a batch at once, one level at a time. Attributions are path-dependent Shapley values. On
the way to a leaf every feature has a share of the training rows that its splits let through (its zero fraction) and, for
a row, the fact whether the row passes them all. With few features on a path there are few patterns of facts, so the
Shapley value of each feature is tabulated per leaf and pattern, and a row only looks its pattern up.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Features on a path up to which patterns are tabulated; a deeper path is an error.
PATH_FEATURES = 14
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, cover double"
_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


@dataclass
class FlatTree:
    """Nodes in pre-order; a leaf has feature -1. Leaves are numbered in the same order."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @classmethod
    def parse(cls, text: str) -> FlatTree:
        """The tree that a fitted model prints; all splits must be on numbers."""
        lines = iter([line.strip() for line in text.splitlines()[1:] if line.strip()])
        nodes: list[list[float]] = []

        def read(line: str) -> int:
            at = len(nodes)
            leaf = _LEAF.fullmatch(line)
            if leaf:
                nodes.append([-1, 0.0, -1, -1, float(leaf[1])])
                return at
            split = _SPLIT.fullmatch(line)
            if not split:
                raise ValueError(f"cannot read the node {line!r}")
            nodes.append([int(split[1]), float(split[2]), -1, -1, 0.0])
            nodes[at][2] = read(next(lines))
            next(lines)  # the Else of the same split
            nodes[at][3] = read(next(lines))
            return at

        read(next(lines))
        feature, threshold, left, right, value = zip(*nodes, strict=True)
        whole = [np.array(v, np.int64) for v in (feature, left, right)]
        return cls(whole[0], np.array(threshold), whole[1], whole[2], np.array(value), np.zeros(len(nodes)))

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.feature < 0)

    def with_leaves(self, values: Sequence[float], covers: Sequence[float]) -> FlatTree:
        """The same splits with new leaf values; covers of inner nodes are sums of their leaves'."""
        value, cover = np.zeros(len(self.feature)), np.zeros(len(self.feature))
        value[self.leaves], cover[self.leaves] = values, covers
        for node in range(len(cover) - 1, -1, -1):
            if self.feature[node] >= 0:
                cover[node] = cover[self.left[node]] + cover[self.right[node]]
        return FlatTree(self.feature, self.threshold, self.left, self.right, value, cover)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """Leaf node that each row ends in."""
        at = np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(open_):
            node = at[open_]
            low = rows[open_, self.feature[node]] <= self.threshold[node]
            at[open_] = np.where(low, self.left[node], self.right[node])
            open_ = open_[self.feature[at[open_]] >= 0]
        return at

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(rows)]

    def paths(self) -> Iterator[tuple[int, dict[int, list[float]]]]:
        """Every leaf with the bounds that its path sets: feature -> [above, up to, share of rows let through]."""
        stack: list[tuple[int, dict[int, list[float]]]] = [(0, {})]
        while stack:
            node, bounds = stack.pop()
            if self.feature[node] < 0:
                yield node, bounds
                continue
            f, t = int(self.feature[node]), float(self.threshold[node])
            for child, low in ((int(self.left[node]), True), (int(self.right[node]), False)):
                above, upto, share = bounds.get(f, [-math.inf, math.inf, 1.0])
                through = self.cover[child] / self.cover[node] if self.cover[node] > 0 else 0.0
                mine = [above, min(upto, t), share * through] if low else [max(above, t), upto, share * through]
                stack.append((child, bounds | {f: mine}))


def shapley_table(shares: np.ndarray) -> np.ndarray:
    """Per pattern of facts (bit k: feature k passes), the weight of each feature of a path for a leaf of value 1.

    The value of a set of features is the product of the facts inside it and of the shares outside it; coalitions are
    summed by size with the coefficients of a polynomial.
    """
    d = len(shares)
    facts = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
    by_size = np.array([math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)])
    out = np.zeros_like(facts)
    for k in range(d):
        sums = np.zeros((len(facts), d))
        sums[:, 0] = 1.0
        for j in range(d):
            if j != k:
                grown = sums * shares[j]
                grown[:, 1:] += sums[:, :-1] * facts[:, j: j + 1]
                sums = grown
        out[:, k] = (sums @ by_size) * (facts[:, k] - shares[k])
    return out


@dataclass
class Ensemble:
    """A start value and trees whose leaf values are added to it."""

    start: float
    trees: list[FlatTree] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.start)
        for tree in self.trees:
            out += tree.score(rows)
        return out

    def base_value(self) -> float:
        """Expected score over the training rows, as the covers of the leaves tell it."""
        total = self.start
        for tree in self.trees:
            leaves = tree.leaves
            if tree.cover[0] > 0:
                total += float(tree.value[leaves] @ tree.cover[leaves] / tree.cover[0])
        return total

    def attribution(self) -> _Attribution:
        return _Attribution(self)

    # -- on Spark ----------------------------------------------------------------------------------------------------

    def score_column(self, features: str = "features") -> Column:
        """The score of a vector column."""

        @F.arrow_udf("double")
        def score(rows: pa.Array) -> pa.Array:
            return pa.array(self.score(matrix(rows)))

        return score(vector_to_array(features))

    def attributed(self, frame: DataFrame, names: Sequence[str], prefix: str, features: str = "features") -> DataFrame:
        """The frame with one attribution column per feature, base_value and model_output (the score)."""
        table = self.attribution()

        @F.arrow_udf("array<double>")
        def explain(rows: pa.Array) -> pa.Array:
            x = matrix(rows)
            values = table.values(x)
            whole = np.concatenate([values, self.score(x)[:, None]], axis=1)
            edges = np.arange(len(x) + 1, dtype=np.int32) * whole.shape[1]
            return pa.ListArray.from_arrays(pa.array(edges), pa.array(whole.ravel()))

        told = frame.withColumn("_told", explain(vector_to_array(features)))
        made = {f"{prefix}{name}": F.col("_told")[k] for k, name in enumerate(names)}
        made |= {"base_value": F.lit(self.base_value()), "model_output": F.col("_told")[len(names)]}
        return told.withColumns(made).drop("_told")

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; tree -1 holds the start value."""
        rows = [(-1, 0, -1, 0.0, -1, -1, float(self.start), 0.0)]
        for n, t in enumerate(self.trees):
            columns = (t.feature, t.threshold, t.left, t.right, t.value, t.cover)
            rows += [(n, k, *v) for k, v in enumerate(zip(*(c.tolist() for c in columns), strict=True))]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @classmethod
    def of_table(cls, nodes: DataFrame) -> Ensemble:
        """The ensemble of a node table; nodes are bounded by trees times leaves."""
        rows = nodes.orderBy("tree", "node").collect()
        out = cls(rows[0]["value"])
        grouped: dict[int, list] = {}
        for r in rows[1:]:
            grouped.setdefault(r["tree"], []).append(r)
        for n in sorted(grouped):
            column = {c: [r[c] for r in grouped[n]] for c in ("feature", "threshold", "left", "right", "value", "cover")}
            whole = {c: np.array(column[c], np.int64) for c in ("feature", "left", "right")}
            real = {c: np.array(column[c], float) for c in ("threshold", "value", "cover")}
            out.trees.append(FlatTree(**whole, **real))
        return out


class _Attribution:
    """Tabulated Shapley values of an ensemble."""

    def __init__(self, ensemble: Ensemble):
        self.leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for tree in ensemble.trees:
            for leaf, bounds in tree.paths():
                if not bounds or not tree.value[leaf]:
                    continue
                if len(bounds) > PATH_FEATURES:
                    raise ValueError(f"a path splits on {len(bounds)} features; {PATH_FEATURES} can be tabulated")
                above, upto, shares = np.array(list(bounds.values())).T
                table = shapley_table(shares) * tree.value[leaf]
                self.leaves.append((np.array(list(bounds), np.int64), above, upto, table))

    def values(self, rows: np.ndarray) -> np.ndarray:
        """One attribution per row and feature."""
        out = np.zeros(rows.shape)
        for features, above, upto, table in self.leaves:
            x = rows[:, features]
            pattern = ((x > above) & (x <= upto)) @ (1 << np.arange(len(features)))
            out[:, features] += table[pattern]
        return out


def matrix(rows: pa.Array) -> np.ndarray:
    """Rows of a list column of one length as a matrix."""
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1) if len(rows) else np.zeros((0, 0))
