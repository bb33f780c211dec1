"""Fitted forests as tables, and what each feature adds to a row's probability.

``tree_table`` reads a fitted forest back from its own saved form: one row a
node.  ``attributions`` walks a batch of rows down all trees at once: a step
from a node to its child changes the expected probability, and the change
belongs to the feature that the node splits on.  Per row the changes sum to
the probability minus the forest's base value, exactly.  One walk serves all
features, where replacing each feature in turn scores a row once a feature.

``shapley`` gives the exact Shapley values of the same trees (a feature left
out follows both branches by their training weight): it sums, over the leaves,
the leaf's share for every subset of the features on its path, as polynomial
coefficients.  It costs some thousand times the walk and is for audits of few rows.
"""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.session import scratch_path


def tree_table(forest, scratch_name: str = "forest") -> DataFrame:
    """(tree, node, feature, threshold, left, right, value, weight) of a fitted two-class forest.  ``value`` is the
    positive class's share of the training weight in the node; a leaf's children are -1."""
    spark = SparkSession.active()
    path = scratch_path(spark, scratch_name)
    forest.save(path)
    n = F.col("nodeData")
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, b: a + b)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        F.when(total > 0, F.get(n["impurityStats"], 1) / total).otherwise(0.0).alias("value"), total.alias("weight"))


class Forest:
    """The nodes of all trees in arrays; ``trees * 2**(depth + 1)`` nodes at most, so a forest may be sent to every task."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r.tree, r.node))
        start = {}
        for i, r in enumerate(rows):
            start.setdefault(r.tree, i)
        at = np.array([start[r.tree] for r in rows], np.int64)
        here = np.arange(len(rows))
        leaf = np.array([r.left < 0 for r in rows], bool)
        self.roots = np.array(sorted(start.values()), np.int64)
        self.leaf = leaf
        self.feature = np.array([max(r.feature, 0) for r in rows], np.int64)
        self.threshold = np.array([0.0 if r.threshold is None else r.threshold for r in rows])
        self.left = np.where(leaf, here, at + np.array([r.left for r in rows]))
        self.right = np.where(leaf, here, at + np.array([r.right for r in rows]))
        self.value = np.array([r.value for r in rows])
        self.weight = np.array([r.weight for r in rows])
        #: A node's children, right and left; the change of the value on the step to a node.
        self.child = np.column_stack([self.right, self.left]).reshape(-1)
        self.inner = ~leaf
        self.added = np.zeros(len(rows))
        for side in (self.left, self.right):
            self.added[side[self.inner]] = self.value[side[self.inner]] - self.value[self.inner]
        #: Probability of a row about which nothing is known.
        self.base = float(self.value[self.roots].mean())

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """(rows, features): what each feature adds to the row's probability over ``base``."""
        values, out = np.ascontiguousarray(x).reshape(-1), np.zeros(x.size)
        start = np.arange(len(x)) * x.shape[1]
        for root in self.roots.tolist():
            if self.leaf[root]:
                continue
            node, row = np.full(len(x), root), start
            while len(row):
                cell = row + self.feature.take(node)
                child = self.child.take(2 * node + (values.take(cell) <= self.threshold.take(node)))
                out[cell] += self.added.take(child)                 # a row has one cell in a step
                more = np.flatnonzero(self.inner.take(child))
                row, node = row.take(more), child.take(more)
        return out.reshape(x.shape) / len(self.roots)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """The mean over the trees of the share in the row's leaf."""
        values, out = np.ascontiguousarray(x).reshape(-1), np.zeros(len(x))
        start = np.arange(len(x)) * x.shape[1]
        for root in self.roots.tolist():
            node, row = np.full(len(x), root), np.arange(len(x))
            while len(row) and not self.leaf[root]:
                cell = start.take(row) + self.feature.take(node)
                node = self.child.take(2 * node + (values.take(cell) <= self.threshold.take(node)))
                ended = self.leaf.take(node)
                if ended.any():
                    out[row[ended]] += self.value.take(node[ended])
                    row, node = row[~ended], node[~ended]
            if self.leaf[root]:
                out += self.value[root]
        return out / len(self.roots)

    def _paths(self):
        """Per leaf: its value, and (feature, low, high, share) for each feature on its path: the
        interval that leads there, and the training weight's share that does without the feature."""
        for root in self.roots.tolist():
            open_ = [(root, {})]
            while open_:
                node, path = open_.pop()
                if self.leaf[node]:
                    yield self.value[node], path
                    continue
                f, t = int(self.feature[node]), self.threshold[node]
                lo, hi, share = path.get(f, (-np.inf, np.inf, 1.0))
                for child, bounds in ((self.left[node], (lo, min(hi, t))), (self.right[node], (max(lo, t), hi))):
                    open_.append((int(child), {**path, f: (*bounds, share * self.weight[child] / self.weight[node])}))

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """(rows, features): exact Shapley values; they too sum to the probability minus ``base``."""
        out = np.zeros(x.shape)
        for value, path in self._paths():
            m = len(path)
            inside = {f: ((x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, (lo, hi, _) in path.items()}
            sizes = [factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)]
            for f in path:
                # Coefficient k: over the subsets of k other features, known ones inside and the rest by their share.
                poly = [np.ones(len(x))]
                for g, (_, _, share) in path.items():
                    if g != f:
                        poly = [(poly[k] * share if k < len(poly) else 0.0) + (poly[k - 1] * inside[g] if k else 0.0) for k in range(len(poly) + 1)]
                weighted = sum(w * c for w, c in zip(sizes, poly))
                out[:, f] += value * weighted * (inside[f] - path[f][2])
        return out / len(self.roots)
