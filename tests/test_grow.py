"""Growing the forests: counts, splits and whole trees against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.operators import grow as G
from clinrisk.operators import model as M
from small import SMALL


def nodes(forest):
    return [a.tolist() for a in (forest.roots, forest.leaf, forest.feature, forest.threshold, forest.left, forest.right, forest.value, forest.weight)]


def test_the_trees_of_a_fit_do_not_depend_on_its_partitions(spark, monkeypatch):
    from clinrisk.plans import load as L
    fits = []
    for most in (2_000, 300, 200):              # 1, 4 and 8 partitions
        monkeypatch.setattr(M, "FIT_ROWS", most)
        fits.append(M.forests(M.fit(L.stored_features(spark, SMALL), num_trees=5, max_depth=4)))
    for name in ("readmission", "deterioration"):
        assert nodes(fits[0][name]) == nodes(fits[1][name]) == nodes(fits[2][name])
        assert len(fits[0][name].roots) == 5 and len(fits[0][name].leaf) > 5


def test_candidates_are_midpoints_or_weighted_quantiles():
    w = np.array([0.5, 2.0])
    few, counts = G.value_counts(np.array([3.0, 1.0, 1.0, 7.0]), np.array([0, 1, 0, 0]))
    assert few.tolist() == [1, 3, 7] and counts.tolist() == [[1, 1], [1, 0], [1, 0]]
    assert G.candidates(few, counts, w).tolist() == [2, 5] and G.candidates(few[:1], counts[:1], w).tolist() == []
    rng = np.random.default_rng(1)
    values, labels = rng.integers(0, 200, 3000).astype(float) ** 2, rng.integers(0, 2, 3000)
    found, counts = G.value_counts(values, labels)
    # MLlib's rule: one threshold a stride of weight, where the running weight is nearest to it.
    want, stride, held, target = [], (counts * w).sum() / G.BINS, (counts[0] * w).sum(), (counts * w).sum() / G.BINS
    for i in range(1, len(found)):
        before, held = held, held + (counts[i] * w).sum()
        if abs(before - target) < abs(held - target):
            want.append((found[i - 1] + found[i]) / 2)
            target += stride
    got = G.candidates(found, counts, w)
    assert len(got) == 31 and len(set(got.tolist()) ^ set(want)) <= 1


def test_many_values_are_joined_into_ranges(monkeypatch):
    monkeypatch.setattr(G, "SKETCH", 10)
    values, labels = np.arange(1000.0)[::-1], np.arange(1000) % 2
    found, counts = G.value_counts(values, labels)
    assert len(found) == 10 and found[-1] == 999 and counts.sum(axis=0).tolist() == [500, 500] and counts.sum(axis=1).max() <= 101


def test_bootstrap_counts_are_poisson_and_belong_to_the_row():
    ids = np.arange(50_000)
    drawn = np.concatenate([G.bootstrap(ids, 42, four) for four in range(3)])
    assert drawn.mean() == pytest.approx(1, abs=0.01) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.005) and drawn.var() == pytest.approx(1, abs=0.02)
    assert (G.bootstrap(ids[::-1].copy(), 42, 1)[:, ::-1] == drawn[4:8]).all()
    assert abs(np.corrcoef(drawn) - np.eye(12)).max() < 0.02 and (G.bootstrap(ids, 43, 0) != drawn[:4]).any()


def _plain_tree(t, x, y, drawn, edges, w, depth, seed):
    """{heap number: (feature, threshold, weighted classes)} of a tree before pruning, grown row by row."""
    width, k = x.shape[1], int(np.ceil(np.sqrt(x.shape[1])))
    out, open_ = {}, {1: np.repeat(np.arange(len(x)), drawn)}

    def gini(rows):
        n = np.bincount(y[rows], minlength=2) * w
        return n.sum(), 1 - ((n / n.sum()) ** 2).sum()
    for level in range(depth + 1):
        rng, below = np.random.default_rng([seed, t, level]), {}
        split = {i: r for i, r in sorted(open_.items()) if level < depth and (i == 1 or 0 < y[r].sum() < len(r))}
        subsets = dict(zip(split, np.sort(rng.random((len(split), width)).argsort(axis=1)[:, :k], axis=1)))
        for i, rows in open_.items():
            best = (1e-13, None, None)
            for f in subsets.get(i, []):
                for e in edges[f]:
                    a, b = rows[x[rows, f] <= e], rows[x[rows, f] > e]
                    if len(a) and len(b):
                        s, g = gini(rows)
                        gain = g - gini(a)[0] / s * gini(a)[1] - gini(b)[0] / s * gini(b)[1]
                        if gain > best[0] + 1e-13:
                            best = (gain, f, e)
            out[i] = (best[1], best[2], np.bincount(y[rows], minlength=2) * w)
            if best[1] is not None:
                below |= {2 * i: rows[x[rows, best[1]] <= best[2]], 2 * i + 1: rows[x[rows, best[1]] > best[2]]}
        open_ = below
    return out


def _plain_probability(tree, i, row):
    f, e, n = tree[i]
    if f is None:
        return n[1] / n.sum()
    return _plain_probability(tree, 2 * i + int(row[f] > e), row) if not _joined(tree, i) else n[1] / n.sum()


def _joined(tree, i):
    """Whether the node's subtree is one leaf after pruning."""
    if tree[i][0] is None:
        return True
    says = [tree[2 * i + s][2][1] > tree[2 * i + s][2][0] for s in (0, 1)]
    return _joined(tree, 2 * i) and _joined(tree, 2 * i + 1) and says[0] == says[1]


def test_whole_trees_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(G, "CHUNK_ROWS", 64)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 12, 300), rng.normal(size=300).round(3), rng.integers(0, 2, 300), np.ones(300), rng.integers(0, 50, 300)]).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 0.3) | (rng.random(300) < 0.1)).astype(int)
    cols, w = list("abcde"), (300 / (2 * (y == 0).sum()), 300 / (2 * (y == 1).sum()))
    rows = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))], "feature_row_id long, y int, " + ", ".join(f"{c} double" for c in cols))
    forest = G.grow(rows.repartition(3), cols, "y", w, 6, 5, 42)
    edges = [G.candidates(*G.value_counts(x[:, f], y), np.array(w)) for f in range(5)]
    drawn = np.concatenate([G.bootstrap(np.arange(300), 42, four) for four in range(2)])
    trees = [_plain_tree(t, x, y, drawn[t], edges, np.array(w), 5, 42) for t in range(6)]
    want = [np.mean([_plain_probability(t, 1, row) for t in trees]) for row in x]
    assert np.allclose(forest.probability(x), want, atol=1e-9)
    assert np.allclose(forest.base + forest.attributions(x).sum(axis=1), want, atol=1e-9)
    assert np.allclose(forest.weight[forest.roots], [t[1][2].sum() for t in trees])


def test_a_forest_is_as_good_as_the_librarys(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 9)).round(2)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=4000) > 0.4).astype(int)
    cols = [f"c{i}" for i in range(9)]
    rows = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))], "feature_row_id long, y int, " + ", ".join(f"{c} double" for c in cols))
    train, test = rows.where("feature_row_id < 3000"), x[3000:]
    ours = G.grow(train, cols, "y", (1.0, 1.0), 100, 6, 42).probability(test)
    made = VectorAssembler(inputCols=cols, outputCol="features")
    theirs = RandomForestClassifier(labelCol="y", numTrees=100, maxDepth=6, seed=42).fit(made.transform(train))
    theirs = np.array([r.probability[1] for r in theirs.transform(made.transform(rows.where("feature_row_id >= 3000").orderBy("feature_row_id"))).select("probability").collect()])

    def auc(p):
        order = p.argsort().argsort()
        pos = y[3000:] == 1
        return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc(ours) == pytest.approx(auc(theirs), abs=0.02) and np.corrcoef(ours, theirs)[0, 1] > 0.97


def test_rows_of_one_class_and_no_rows(spark):
    rows = spark.createDataFrame([(i, 0, float(i)) for i in range(30)], "feature_row_id long, y int, a double")
    forest = G.grow(rows, ["a"], "y", (1.0, 1.0), 3, 4, 42)
    assert len(forest.leaf) == 3 and forest.probability(np.zeros((2, 1))).tolist() == [0, 0]
    sure = G.grow(rows.withColumn("y", F.lit(1)), ["a"], "y", (1.0, 1.0), 3, 4, 42)
    assert sure.probability(np.zeros((2, 1))).tolist() == [1, 1]
    assert G.grow(rows.limit(0), ["a"], "y", (1.0, 1.0), 3, 4, 42).probability(np.zeros((1, 1))).tolist() == [0]
    rm = M.RiskModels({n: ["a"] for n in C.TARGETS}, {n: {"a": 0.0} for n in C.TARGETS}, {"readmission": forest, "deterioration": sure, "mortality": None}, rows, rows)
    assert M.forests(rm)["readmission"] is None and M.forests(rm)["deterioration"] is sure
    got = M.probabilities(rm, rows.withColumn("a", F.when(F.col("a") > 5, F.col("a"))))
    assert got.columns == [*rows.columns, "p_readmission", "p_deterioration", "p_mortality"]
    assert {(r.p_readmission, r.p_deterioration, r.p_mortality) for r in got.collect()} == {(0.0, 1.0, 0.0)}


def test_scores_fill_missing_values_with_each_targets_medians(spark):
    rows = spark.createDataFrame([(i, i % 2, float(i % 2)) for i in range(200)], "feature_row_id long, y int, a double")
    forest = G.grow(rows, ["a"], "y", (1.0, 1.0), 8, 3, 42)
    rm = M.RiskModels({n: ["a"] for n in C.TARGETS}, {"readmission": {"a": 1.0}, "deterioration": {"a": 0.0}, "mortality": {"a": 0.0}}, {n: forest for n in C.TARGETS}, rows, rows)
    (r,) = M.probabilities(rm, spark.createDataFrame([(1, None)], "feature_row_id long, a double")).collect()
    assert (r.p_readmission, r.p_deterioration, r.a) == (1.0, 0.0, None)
