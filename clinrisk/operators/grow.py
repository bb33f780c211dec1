"""Growing the forests (H4): all trees level by level, from counts of binned rows.

The rows are binned once (``BINS`` classes a feature, a byte each) and stored.  A
level is one job: a task walks its rows down each tree as far as it is, counts
them by (node, feature of the node's subset, bin, class) and sends one block of
counts a tree; the blocks of a tree are summed in one task, which picks every node's
split.  Only splits and class counts reach the driver.  A task works on one
tree after the other, so it holds its rows' bytes and the counts of four trees.

A row's bootstrap counts are Poisson(1) draws (to 16 bits) from a hash of (seed, tree, row id), and
counts are whole numbers that meet the class weights when a split is judged: how the rows are
dealt does not matter to the trees (but to the candidates of a feature with more than ``SKETCH`` values in a task,
which are right to a part in ``SKETCH`` of the rows).  Candidates, gain, stopping rules and pruning are MLlib's:
midpoints between neighbouring values, by weighted quantiles if there are more than ``BINS``; weighted Gini gain;
a node is a leaf if it is pure, at ``max_depth`` or without gain; leaves of one parent and prediction are joined.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clinrisk.operators.forest import Forest
from clinrisk.session import remove_path, scratch_path, ship

BINS = 32
#: Values of a feature that a task sends at most; more are joined into as many ranges of equal counts.
SKETCH = 4096
#: Rows that are walked at once.
CHUNK_ROWS = 1 << 16

Node = namedtuple("Node", "tree node feature threshold left right value weight")


# --- Bins ------------------------------------------------------------------------------

def value_counts(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and their rows by class; past ``SKETCH`` values the largest of each range."""
    found, at = np.unique(values, return_inverse=True)
    counts = np.stack([np.bincount(at[labels == c], minlength=len(found)) for c in (0, 1)], axis=1)
    if len(found) > SKETCH:
        place = counts.sum(axis=1).cumsum() * SKETCH // (len(values) + 1)
        last = np.flatnonzero(np.append(place[1:] != place[:-1], True))
        found, counts = found[last], np.diff(counts.cumsum(axis=0)[last], axis=0, prepend=0)
    return found, counts


def candidates(values: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The thresholds of a feature with these distinct values, ascending, and rows by class: ``BINS - 1`` at most."""
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) >= BINS:
        held = (counts * weights).sum(axis=1).cumsum()
        between, picked = (held[:-1] + held[1:]) / 2.0, []
        for k in range(1, BINS):
            i = max(picked[-1] + 1 if picked else 0, int(np.searchsorted(between, held[-1] / BINS * k, side="right")))
            if i >= len(middle):
                break
            picked.append(i)
        middle = middle[picked]
    return np.unique(middle[~np.isnan(middle)])


def _columns(batch: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols]) if cols else np.zeros((batch.num_rows, 1))


def thresholds(rows: DataFrame, cols: list[str], label: str, weights: np.ndarray) -> list[np.ndarray]:
    """Per feature its split candidates, from all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(_columns(b, cols), b.column(label).to_numpy()) for b in batches]
        if not sum(len(y) for _, y in parts):
            return
        x, y = np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])
        for f in range(len(cols)):
            values, counts = value_counts(x[:, f], y)
            yield pa.RecordBatch.from_pydict({"feature": pa.array([f], pa.int32()), "vals": [values.tobytes()], "counts": [counts.astype(np.int64).tobytes()]})

    def join(table: pa.Table) -> pa.Table:
        values = np.concatenate([np.frombuffer(b, float) for b in table["vals"].to_pylist()])
        counts = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 2) for b in table["counts"].to_pylist()])
        found, at = np.unique(values, return_inverse=True)
        summed = np.stack([np.bincount(at, counts[:, c], minlength=len(found)) for c in (0, 1)], axis=1)
        return pa.table({"feature": table["feature"].slice(0, 1), "vals": [candidates(found, summed, weights).tobytes()]})
    sent = rows.select(label, *cols).mapInArrow(count, "feature int, vals binary, counts binary")
    got = {r.feature: np.frombuffer(r.vals, float) for r in sent.groupBy("feature").applyInArrow(join, "feature int, vals binary").collect()}
    return [got.get(f, np.zeros(0)) for f in range(max(len(cols), 1))]


def binned(rows: DataFrame, cols: list[str], label: str, row_id: str, edges: list[np.ndarray]) -> DataFrame:
    """(ids, labels, bins): blocks of ``CHUNK_ROWS`` rows at most; a value's bin is the number of thresholds below it."""
    def block(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        bins = np.empty(x.shape, np.uint8)
        for f, edge in enumerate(edges):
            bins[:, f] = np.searchsorted(edge, x[:, f])
        return pa.RecordBatch.from_pydict({"ids": [ids.tobytes()], "labels": [y.astype(np.uint8).tobytes()], "bins": [bins.tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, CHUNK_ROWS):
                part = b.slice(at, CHUNK_ROWS)
                if n + part.num_rows > CHUNK_ROWS:
                    yield block(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
                held.append((_columns(part, cols), part.column(label).to_numpy(), part.column(row_id).fill_null(-1).to_numpy()))
                n += part.num_rows
        if n:
            yield block(*map(np.concatenate, zip(*held)))
    return rows.select(row_id, label, *cols).mapInArrow(run, "ids binary, labels binary, bins binary")


# --- Bootstrap -------------------------------------------------------------------------

def _poisson_table() -> np.ndarray:
    """The Poisson(1) count of each 16-bit draw."""
    edges = np.floor(np.cumsum([exp(-1) / factorial(k) for k in range(12)]) * 65536 + 0.5)
    return np.searchsorted(edges, np.arange(65536), side="right").astype(np.uint8)


POISSON = _poisson_table()


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bootstrap(ids: np.ndarray, seed: int, four: int) -> np.ndarray:
    """(4, rows): how often trees ``4 * four`` to ``4 * four + 3`` draw each row."""
    step = np.array([0x9E3779B97F4A7C15], np.uint64)                 # products of arrays wrap around
    key = _mixed(_mixed(np.array([seed], np.int64).view(np.uint64) + step) + np.array([four + 1], np.uint64) * step)
    z = _mixed(ids.view(np.uint64) * step + key)
    return np.stack([POISSON.take((z >> np.uint64(16 * j)).astype(np.uint16)) for j in range(4)])


# --- Levels ------------------------------------------------------------------------------
# Nodes are numbered as in a heap: the root is 1, the children of i are 2 i and 2 i + 1.

class Level:
    """One tree as the tasks of a level need it: ``feature`` and ``bin`` of the nodes above (a leaf sends all rows to
    the left), ``slot`` of the level's nodes (-1: nothing to split), ``subset`` (a node's features), ``alive`` (nodes
    with a node to split below)."""

    def __init__(self, feature: np.ndarray, bins: np.ndarray, slot: np.ndarray, subset: np.ndarray, alive: np.ndarray):
        self.feature, self.bins, self.slot, self.subset, self.alive = feature, bins, slot, subset, alive


def level_counts(tree: Level, level: int, drawn: np.ndarray, labels: np.ndarray, bins: np.ndarray, width: int) -> np.ndarray:
    """(features of a subset, nodes, bins, classes): the drawn rows' counts, flat."""
    row = np.flatnonzero(drawn)
    base, node = row * width, np.ones(len(row), np.int64)
    for depth in range(level):
        right = bins.take(base + tree.feature.take(node)) > tree.bins.take(node)
        node += node
        node += right
        if depth % 3 == 2:
            stay = tree.alive.take(node)
            if 4 * np.count_nonzero(stay) < 3 * len(stay):
                row, base, node = row[stay], base[stay], node[stay]
    slot = tree.slot.take(node - (1 << level))
    if len(slot) and slot.min() < 0:
        stay = slot >= 0
        row, base, slot = row[stay], base[stay], slot[stay]
    weight, m = drawn.take(row).astype(float), len(tree.subset)
    first = slot * (2 * BINS) + labels.take(row)
    return np.concatenate([np.bincount(first + 2 * bins.take(base + features.take(slot)).astype(np.int64), weight, minlength=m * 2 * BINS)
                           for features in tree.subset.T])


def best_splits(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(nodes, 6): place in the subset (-1: no split), bin, the node's rows by class, the left child's rows by class."""
    total = counts[0].sum(axis=1)
    left = counts.cumsum(axis=2)[:, :, :-1]
    right = total[None, :, None] - left

    def gini(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = n * weights
        s = n.sum(axis=-1)
        return s, 1.0 - ((n / np.where(s > 0, s, 1.0)[..., None]) ** 2).sum(axis=-1)
    (all_, here), (l, gl), (r, gr) = gini(total), gini(left), gini(right)
    some = np.where(all_ > 0, all_, 1.0)[None, :, None]
    gain = here[None, :, None] - l / some * gl - r / some * gr
    gain = np.where((left.sum(axis=-1) < 1) | (right.sum(axis=-1) < 1), -1.0, gain)
    gain = gain.transpose(1, 0, 2).reshape(len(total), -1)
    pick = gain.argmax(axis=1)
    place, at = np.divmod(pick, BINS - 1)
    found = gain[np.arange(len(total)), pick] > 0
    return np.column_stack([np.where(found, place, -1), at, total, left[place, np.arange(len(total)), at]]).astype(np.int64)


def _smallest(counts: np.ndarray) -> bytes:
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max(initial=0) <= np.iinfo(k).max)
    return counts.astype(kind).tobytes()


def _read(block: bytes, size: int) -> np.ndarray:
    return np.frombuffer(block, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[len(block) // size])


def split_level(rows: DataFrame, trees: dict[int, Level], level: int, weights: np.ndarray, seed: int, width: int) -> dict[int, np.ndarray]:
    """``best_splits`` of every tree's nodes to split."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(trees)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.frombuffer(i, np.int64), np.frombuffer(y, np.uint8), np.frombuffer(x, np.uint8))
                for b in batches for i, y, x in zip(*(b.column(c).to_pylist() for c in ("ids", "labels", "bins")))]
        for four in sorted({t // 4 for t in sent.value}):
            mine = [t for t in range(4 * four, 4 * four + 4) if t in sent.value]
            sums = {t: 0 for t in mine}
            for ids, labels, bins in held:
                drawn = bootstrap(ids, seed, four)
                for t in mine:
                    sums[t] = sums[t] + level_counts(sent.value[t], level, drawn[t % 4], labels, bins, width)
            if held:
                yield pa.RecordBatch.from_pydict({"tree": pa.array(mine, pa.int32()), "counts": [_smallest(sums[t]) for t in mine]})

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for t, block in zip(b.column("tree").to_pylist(), b.column("counts")):
                part = _read(block.as_buffer(), sent.value[t].subset.size * 2 * BINS)
                if t in sums:
                    sums[t] += part
                else:
                    sums[t] = part.astype(np.int64)
        for t, counts in sums.items():
            m, k = sent.value[t].subset.shape
            found = best_splits(counts.reshape(k, m, BINS, 2), weights)
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "splits": [found.tobytes()]})
    sums = rows.mapInArrow(count, "tree int, counts binary")
    parts = min(len(trees), max(spark.sparkContext.defaultParallelism, -(-len(trees) // 8)))
    out = {r.tree: np.frombuffer(r.splits, np.int64).reshape(-1, 6)
           for r in sums.repartition(parts, "tree").mapInArrow(choose, "tree int, splits binary").collect()}     # trees * 2**level rows of six numbers
    sent.destroy()
    return out


# --- Trees -------------------------------------------------------------------------------

def grow(rows: DataFrame, cols: list[str], label: str, weights: tuple[float, float], num_trees: int, max_depth: int, seed: int,
         row_id: str = "feature_row_id") -> Forest:
    """The forest of the stored ``rows``: ``label`` is 0 or 1, ``cols`` are doubles without nulls."""
    ship(rows.sparkSession)
    by_class = np.array(weights, float)
    edges = thresholds(rows, cols, label, by_class)
    width = len(edges)
    k = int(np.ceil(np.sqrt(width)))
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "fit-bins")
    binned(rows, cols, label, row_id, edges).write.parquet(path)
    data = spark.read.parquet(path)
    size = 1 << (max_depth + 1)
    feature, bins = np.full((num_trees, size), -1, np.int64), np.zeros((num_trees, size), np.int64)
    classes = np.zeros((num_trees, size, 2), np.int64)
    open_ = {t: np.array([1]) for t in range(num_trees)} if max_depth else {}
    for level in range(max_depth):
        trees = {}
        for t, nodes in open_.items():
            rng = np.random.default_rng([abs(seed), t, level])
            subset = np.sort(rng.random((len(nodes), width)).argsort(axis=1)[:, :k], axis=1)
            slot = np.full(1 << level, -1, np.int64)
            slot[nodes - (1 << level)] = np.arange(len(nodes))
            alive = np.zeros(2 << level, bool)
            for up in range(level + 1):
                alive[nodes >> up] = True
            above, leaf = feature[t, :1 << level], feature[t, :1 << level] < 0
            trees[t] = Level(np.where(leaf, 0, above), np.where(leaf, BINS, bins[t, :1 << level]), slot, subset, alive)
        if not trees:
            break
        found = split_level(data, trees, level, by_class, seed, width)
        for t, nodes in list(open_.items()):
            if t not in found:
                del open_[t]
                continue
            place, at, total, left = found[t][:, 0], found[t][:, 1], found[t][:, 2:4], found[t][:, 4:6]
            classes[t, nodes] = total
            s = np.flatnonzero(place >= 0)
            feature[t, nodes[s]], bins[t, nodes[s]] = trees[t].subset[s, place[s]], at[s]
            classes[t, 2 * nodes[s]], classes[t, 2 * nodes[s] + 1] = left[s], (total - left)[s]
            below = np.concatenate([2 * nodes[s], 2 * nodes[s] + 1])
            open_[t] = np.sort(below[(classes[t, below] > 0).all(axis=1)])         # a pure child is a leaf
            if not len(open_[t]):
                del open_[t]
    remove_path(spark, path)
    return Forest([n for t in range(num_trees) for n in _nodes(t, feature[t], bins[t], classes[t] * by_class, edges)])


def _nodes(tree: int, feature: np.ndarray, bins: np.ndarray, classes: np.ndarray, edges: list[np.ndarray]) -> list[Node]:
    """The pruned tree's nodes from the root on."""
    feature, predicted = feature.copy(), classes[:, 1] > classes[:, 0]
    for i in range(len(feature) // 2 - 1, 0, -1):
        a, b = 2 * i, 2 * i + 1
        if feature[i] >= 0 and feature[a] < 0 and feature[b] < 0 and predicted[a] == predicted[b]:
            feature[i] = -1
    nodes, place = [1], {1: 0}
    for i in nodes:                     # grows as it goes
        if feature[i] >= 0:
            for child in (2 * i, 2 * i + 1):
                place[child] = len(nodes)
                nodes.append(child)
    out = []
    for i in nodes:
        weight, inner = float(classes[i].sum()), feature[i] >= 0
        out.append(Node(tree, place[i], int(feature[i]), float(edges[feature[i]][bins[i]]) if inner else None, place[2 * i] if inner else -1,
                        place[2 * i + 1] if inner else -1, float(classes[i, 1] / weight) if weight > 0 else 0.0, weight))
    return out
