"""Splits, medians, running sums, evaluation edge cases and the forests."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.operators import evaluate as EV
from clinrisk.operators import model as M
from clinrisk.operators import prepare as PR
from clinrisk.operators.forest import Forest, tree_table
from clinrisk.operators import prefix as P
from clinrisk.operators.prefix import prefix_sums, running_count


def test_running_sums_split_a_hot_group(spark):
    rows = [("hot" if i % 10 else "rare", i, i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(5)
    got = {(r.g, r.k): r.before for r in prefix_sums(df, ["g"], ["k"], {"before": F.col("v")}).collect()}
    sums = {"hot": 0, "rare": 0}
    for g, k, v in rows:
        assert got[g, k] == sums[g]
        sums[g] += v


def test_running_count_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_A_PARTITION", 100)
    assert P.partitions_for(1001, spark) == 11              # more rows, more partitions
    df = spark.createDataFrame([(i * 7919 % 1001, i % 3) for i in range(1001)], "k int, v int").repartition(5)
    assert {r.k: r.n for r in running_count(df, ["k"], "n").collect()} == {k: k for k in range(1001)}
    made = running_count(df, [F.col("k").desc()], "n", expand=lambda rows: rows.select("k", F.explode(F.sequence(F.lit(0), F.col("v"))).alias("e"))).collect()
    assert [(r.k, r.e) for r in sorted(made, key=lambda r: r.n)] == [(k, e) for k in range(1000, -1, -1) for e in range({i * 7919 % 1001: i % 3 for i in range(1001)}[k] + 1)]
    assert sorted(r.n for r in made) == list(range(len(made)))
    assert running_count(df.limit(0), ["k"], "n").count() == 0


def test_split_ranks_one_cell_only(spark, monkeypatch):
    ranked = []
    monkeypatch.setattr(PR, "SPLIT_CELLS", 16)
    monkeypatch.setattr(PR, "prefix_sums", lambda df, *a, **k: ranked.append(df.count()) or prefix_sums(df, *a, **k))
    df = spark.createDataFrame([(i, int(i % 9 == 0), int(i % 2 == 0), None) for i in range(1, 901)],
                               "feature_row_id bigint, readmitted_30d bigint, deteriorated bigint, mortality bigint")
    draws = {r[0]: r[1] for r in df.select("feature_row_id", PR.uniform("split", F.col("feature_row_id"), 0)).collect()}
    got = {(r.target, r.feature_row_id): r.is_test for r in PR.stratified_split(df).collect()}
    assert len(got) == 1800 and ranked[0] < 400
    for target, of in (("readmission", lambda i: i % 9 == 0), ("deterioration", lambda i: i % 2 == 0)):
        for cls in (True, False):
            order = sorted((i for i in range(1, 901) if of(i) == cls), key=lambda i: (draws[i], i))
            assert [i for i in order if got[target, i]] == order[:math.floor(0.2 * len(order) + 0.5)]


def test_partitions_of_a_fit(spark):
    assert M._fit_partitions(10, spark) == 1 and M._fit_partitions(100_000, spark) == 4 and M._fit_partitions(5_000_000, spark) == 10


def test_the_last_round_of_a_fits_tasks_is_full(spark):
    cores = spark.sparkContext.defaultParallelism
    for rows in (10, 100_000, 700_000, 5_000_000, 7_056_000):
        few = M._fit_partitions(rows, spark)
        n = M._whole_rounds(few, spark)
        assert n == few if few <= cores else few <= n < few + cores and n % cores == 0


def test_a_fits_rows_are_dealt_in_whole_rounds(spark, monkeypatch):
    monkeypatch.setattr(M, "FIT_ROWS", 300)
    dealt, plain = [], type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda self, n, *c: dealt.append(n) or plain(self, n, *c))
    from clinrisk.plans import load as L
    from small import SMALL
    M.fit(L.stored_features(spark, SMALL), num_trees=1, max_depth=2)
    assert dealt.count(4) == 2                  # 1,176 rows: 4 parts of 300 on 4 cores
    dealt.clear()
    monkeypatch.setattr(M, "FIT_ROWS", 200)
    M.fit(L.stored_features(spark, SMALL), num_trees=1, max_depth=2)
    assert dealt.count(8) == 2 and 6 not in dealt


def test_auc_of_many_distinct_raw_scores(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = random.Random(5)
    rows = [("t", lbl := rng.randint(0, 1), rng.gauss(0.1 * lbl, 1.0)) for _ in range(12_000)]
    df = spark.createDataFrame(rows, "target string, label int, score double")
    ours = EV.roc_auc(df).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert ours == pytest.approx(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))), abs=1e-9)


def test_scores_that_differ_late_are_not_merged(spark):
    df = spark.createDataFrame([("t", 0, 0.123456781), ("t", 1, 0.123456782)], "target string, label int, score double")
    assert EV.roc_auc(df).first().auc == 1.0


def test_report_shows_only_present_classes(spark):
    df = spark.createDataFrame([("t", 0, 0)] * 3, "target string, label int, prediction int")
    rows = {r.label: r for r in EV.classification_report(df).collect()}
    assert set(rows) == {"0", "accuracy", "macro avg", "weighted avg"} and rows["macro avg"].f1_score == 1.0


FEATURES = ("feature_row_id bigint, patient_id bigint, admission_id bigint, readmitted_30d bigint, deteriorated bigint, "
            "mortality bigint, gender string, blood_type string, department string, admission_type string, age bigint, los_days bigint, "
            "heart_rate double, systolic_bp double, diastolic_bp double, temperature double, spo2 double, respiratory_rate double, "
            "diagnosis_count bigint, medication_count bigint, creatinine double, hba1c double, wbc double, hemoglobin double, "
            "sodium double, abnormal_labs bigint")


def feature_rows(n, label=lambda i: (i % 2, 0, 0), **over):
    base = {"gender": "Male", "blood_type": None, "department": "X", "admission_type": "Elective", "age": 50, "los_days": 3,
            "heart_rate": 80.0, "systolic_bp": 120.0, "diastolic_bp": 80.0, "temperature": 37.0, "spo2": 97.0, "respiratory_rate": 15.0,
            "diagnosis_count": 1, "medication_count": 1, "creatinine": 1.0, "hba1c": None, "wbc": 7.0, "hemoglobin": 14.0, "sodium": 140.0,
            "abnormal_labs": 4}
    names = [c.split()[0] for c in FEATURES.split(", ")]
    out = []
    for i in range(n):
        r = base | {k: v(i) for k, v in over.items()} | {"feature_row_id": i, "patient_id": i, "admission_id": i}
        r |= dict(zip(("readmitted_30d", "deteriorated", "mortality"), label(i)))
        out.append(tuple(r[c] for c in names))
    return out


def test_split_is_exact_in_every_class(spark):
    df = spark.createDataFrame(feature_rows(503, label=lambda i: (int(i % 9 == 0), int(i < 3), 0)), FEATURES)
    split = PR.stratified_split(df)
    for r in split.groupBy("target", "label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == int(np.floor(0.2 * r.n + 0.5))
    again = PR.stratified_split(df.repartition(3))
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))


def test_half_values_survive_imputation_and_medians_are_exact(spark):
    rng = random.Random(2)
    df = spark.createDataFrame(feature_rows(200, age=lambda i: rng.choice([53, 54, None]), sodium=lambda i: None, creatinine=lambda i: rng.random()), FEATURES)
    frame = PR.model_frame(df)
    split = PR.stratified_split(frame)
    med = {(r.target, r.feature): r.median for r in PR.medians(frame, split).collect()}
    train = PR.training_rows(frame, split, "readmission").toPandas()
    for c in ("age", "creatinine", "shock_index"):
        assert med["readmission", c] == pytest.approx(float(np.nanmedian(train[c].astype(float))))
    assert med["readmission", "sodium"] is None
    small = spark.createDataFrame([(1, None), (2, 53), (3, 54)], "k int, age bigint")
    assert {r.k: r.age for r in PR.impute(small, {"age": 53.5}).collect()} == {1: 53.5, 2: 53.0, 3: 54.0}


def test_unknown_categories_and_a_later_batch_get_the_stored_codes(spark):
    df = spark.createDataFrame(feature_rows(4, gender=lambda i: [None, "Male", "Female", "Male"][i]), FEATURES)
    mapping = PR.label_mapping(df)
    codes = {(r.feature, r.value): r.code for r in mapping.collect()}
    assert [codes["gender", v] for v in ("Female", "Male", "Unknown")] == [0, 1, 2] and codes["blood_type", "Unknown"] == 0
    later = spark.createDataFrame(feature_rows(3, gender=lambda i: ["Male", "Other", None][i], department=lambda i: "new"), FEATURES)
    got = [(r.gender, r.department) for r in PR.label_encode(later, mapping=mapping).orderBy("feature_row_id").collect()]
    assert got == [(1, 1), (2, 1), (2, 1)]


def test_codes_of_a_wide_column(spark):
    rows = [(i, None if i % 50 == 0 else f"v{(i * 7919) % 2000:05}" if i % 3 else "common") for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, c string")
    codes = PR.code_table(df, "c")
    order = {v: i for i, v in enumerate(sorted({v or "Unknown" for _, v in rows}))}
    assert {r.value: r.code for r in codes.collect()} == order
    later = spark.createDataFrame([(1, "common"), (2, None), (3, "never seen")], "k long, c string")
    assert {r.k: r.c for r in PR.encode_by_join(later, "c", codes).collect()} == {1: order["common"], 2: order["Unknown"], 3: order["Unknown"]}


def test_zero_pressure_height_and_missing_bounds(spark):
    df = spark.createDataFrame(feature_rows(2, systolic_bp=lambda i: [0.0, 100.0][i]), FEATURES)
    assert [r.shock_index for r in PR.derived_features(PR.label_encode(df)).orderBy("feature_row_id").collect()] == [None, 0.8]
    from clinrisk.operators.star import bmi, is_abnormal
    r = spark.range(1).select(bmi(F.lit(70.0), F.lit(0.0)).alias("b"), is_abnormal(F.lit(1.0), F.lit(None).cast("double"), F.lit(2.0)).alias("n"),
                              is_abnormal(F.lit(3.0), F.lit(None).cast("double"), F.lit(2.0)).alias("y")).first()
    assert r.b is None and r.n is None and r.y is True


def test_separable_data_pins_the_forest(spark):
    label = lambda i: (int(i % 4 == 0), int(i % 3 == 0), 0)
    df = spark.createDataFrame(feature_rows(400, label, heart_rate=lambda i: 120.0 if i % 4 == 0 else 70.0, spo2=lambda i: 88.0 if i % 3 == 0 else 98.0), FEATURES)
    rm = M.fit(df, num_trees=10)
    frame = PR.model_frame(df, rm.mapping)
    for r in M.probabilities(rm, frame).collect():
        assert (r.p_readmission > 0.5, r.p_deterioration > 0.5, r.p_mortality) == (r.readmitted_30d == 1, r.deteriorated == 1, 0.0)
    auc, report = M.evaluation(rm, frame)
    assert {r.target: r.auc for r in auc.collect()} == {"readmission": 1.0, "deterioration": 1.0, "mortality": None}
    assert {r.target for r in report.collect()} == {"readmission", "deterioration"}
    import json
    top = json.loads(M.top_features(rm, frame).where("feature_row_id = 0").first().top_features)
    assert top["readmission"][0]["feature"] in ("heart_rate", "shock_index") and top["mortality"] == []


def test_positives_only_in_the_hold_out_give_probability_zero(spark, monkeypatch):
    exact = PR.stratified_split
    monkeypatch.setattr(PR, "stratified_split", lambda f: exact(f).withColumn("is_test", F.col("is_test") | (F.col("label") == 1)))
    df = spark.createDataFrame(feature_rows(60, lambda i: (int(i < 3), 0, 0)), FEATURES)
    rm = M.fit(df, num_trees=2)
    assert rm.models["readmission"] is None
    frame = PR.model_frame(df, rm.mapping)
    assert M.probabilities(rm, frame).agg(F.max("p_readmission")).first()[0] == 0.0
    assert {r.target: r.n_pos for r in M.evaluation(rm, frame)[0].collect()}["readmission"] == 3


def test_a_tie_at_one_half_is_class_zero(spark, monkeypatch):
    df = spark.createDataFrame(feature_rows(50), FEATURES)
    rm = M.fit(df, num_trees=2)
    monkeypatch.setattr(M, "probabilities", lambda rm, f: f.withColumns({f"p_{n}": F.lit(0.5) for n in C.TARGETS}))
    assert M.evaluation_rows(rm, PR.model_frame(df, rm.mapping)).agg(F.max("prediction")).first()[0] == 0


# --- Trees as tables, attributions -------------------------------------------------------

def _expected(forest, root, x, known):
    """The tree's mean probability when only the features in ``known`` are given."""
    if forest.leaf[root]:
        return forest.value[root]
    left, right = forest.left[root], forest.right[root]
    if forest.feature[root] in known:
        return _expected(forest, left if x[forest.feature[root]] <= forest.threshold[root] else right, x, known)
    share = forest.weight[left] / forest.weight[root]
    return share * _expected(forest, left, x, known) + (1 - share) * _expected(forest, right, x, known)


def _small_forest(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (400, 4)).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 7)).astype(float) * (x[:, 2] > 2)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, y double")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    fitted = RandomForestClassifier(labelCol="y", numTrees=5, maxDepth=4, seed=1).fit(df)
    return fitted, df, x


def test_trees_read_as_a_table_give_the_fitted_probabilities(spark):
    fitted, df, x = _small_forest(spark)
    forest = Forest(tree_table(fitted).collect())
    want = [r.probability[1] for r in fitted.transform(df).select("probability").collect()]
    assert np.allclose(forest.probability(x), want, atol=1e-12)
    assert np.allclose(forest.base + forest.shapley(x).sum(axis=1), want, atol=1e-12)


def test_shapley_values_against_all_feature_subsets(spark):
    fitted, _, x = _small_forest(spark)
    forest = Forest(tree_table(fitted).collect())
    got, n = forest.shapley(x[:12]), 4
    for row, values in zip(x[:12], got):
        def mean(known):
            return np.mean([_expected(forest, r, row, known) for r in forest.roots])
        for i in range(n):
            others = [j for j in range(n) if j != i]
            want = sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (mean({*s, i}) - mean(set(s)))
                       for k in range(n) for s in itertools.combinations(others, k))
            assert values[i] == pytest.approx(want, abs=1e-12)


def test_contributions_follow_the_path(spark):
    fitted, _, x = _small_forest(spark)
    forest = Forest(tree_table(fitted).collect())
    for row, got in zip(x[:20], forest.attributions(x[:20])):
        want = np.zeros(4)
        for node in forest.roots:
            while not forest.leaf[node]:
                f = forest.feature[node]
                child = forest.left[node] if row[f] <= forest.threshold[node] else forest.right[node]
                want[f] += (forest.value[child] - forest.value[node]) / len(forest.roots)
                node = child
        assert np.allclose(got, want)


def test_stored_lists_hold_the_largest_contributions(spark):
    from clinrisk.plans import load as L
    from small import SMALL
    rm = L.fitted_models(spark, SMALL, 5)
    frame = PR.model_frame(L.stored_features(spark, SMALL), rm.mapping)
    probs = {r.feature_row_id: r for r in M.probabilities(rm, frame).collect()}
    trees, cols = M.forests(rm)["readmission"], rm.features["readmission"]
    x = np.array([[rm.medians["readmission"][c] if probs[i][c] is None else probs[i][c] for c in cols] for i in sorted(probs)])
    added = trees.attributions(x)
    assert np.allclose(trees.base + added.sum(axis=1), [probs[i].p_readmission for i in sorted(probs)], atol=1e-12)
    rows = {r.feature_row_id: json.loads(r.top_features) for r in M.top_features(rm, frame).collect()}
    assert len(rows) == len(probs) and all(v["mortality"] == [] for v in rows.values())
    for i, values in zip(sorted(probs), added):
        want = sorted(((-abs(round(v, 6)), c) for c, v in zip(cols, values)))[:5]
        assert [(-abs(e["contribution"]), e["feature"]) for e in rows[i]["readmission"]] == want
    exact = M.top_features(rm, frame.where("feature_row_id <= 3"), exact=True).collect()
    assert len(exact) == 3


def test_a_walk_down_trees_that_are_a_leaf(spark):
    from collections import namedtuple
    Node = namedtuple("Node", "tree node feature threshold left right value weight")
    leaf = Node(0, 0, -1, None, -1, -1, 0.25, 3.0)
    split = [Node(1, 0, 1, 0.5, 1, 2, 0.5, 4.0), Node(1, 1, -1, None, -1, -1, 0.125, 2.0), Node(1, 2, -1, None, -1, -1, 0.875, 2.0)]
    x = np.array([[9.0, 0.5], [9.0, 0.75]])
    assert Forest([leaf]).attributions(x).tolist() == [[0, 0], [0, 0]]
    assert Forest([leaf, *split]).attributions(x).tolist() == [[0, -0.1875], [0, 0.1875]]
    # A node's step is one table look-up: the children lie in one array, the changes of the value in another.
    assert Forest([leaf, *split]).added.tolist() == [0, 0, -0.375, 0.375]
    assert Forest([leaf, *split]).attributions(x[:0]).shape == (0, 2)
