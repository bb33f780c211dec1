import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinrisk.operators import evaluate as EV
from clinrisk.operators import explain as EX


def test_auc_rank_sum_equals_mllib_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(3)
    rows = [("t", lbl, round(min(1.0, max(0.0, rnd.gauss(0.4 + 0.2 * lbl, 0.2))), 2))
            for lbl in [rnd.randint(0, 1) for _ in range(3000)]]
    df = spark.createDataFrame(rows, "target string, label int, score double")
    ours = EV.roc_auc(df).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC",
                                       numBins=0)
    theirs = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_auc_is_null_for_one_class(spark):
    df = spark.createDataFrame([("m", 0, 0.1), ("m", 0, 0.2)], "target string, label int, score double")
    assert EV.roc_auc(df).first().auc is None


def test_classification_report_by_hand(spark):
    # tp=2 fp=1 fn=1 tn=4
    rows = [(1, 1)] * 2 + [(0, 1)] + [(1, 0)] + [(0, 0)] * 4
    df = spark.createDataFrame([("t", a, b) for a, b in rows], "target string, label int, prediction int")
    rep = {r.label: r for r in EV.classification_report(df).collect()}
    assert rep["1"].precision == pytest.approx(2 / 3) and rep["1"].recall == pytest.approx(2 / 3)
    assert rep["0"].precision == pytest.approx(0.8) and rep["0"].recall == pytest.approx(0.8)
    assert rep["accuracy"].f1_score == pytest.approx(6 / 8) and rep["accuracy"].support == 8
    assert rep["weighted avg"].precision == pytest.approx((0.8 * 5 + 2 / 3 * 3) / 8)


def _pending(spark, rows):
    return spark.createDataFrame(rows, "score_id long, patient_id long, admission_id long, "
                                       "readmission_risk double, deterioration_risk double, mortality_risk double, "
                                       "readmission_tier string, deterioration_tier string, mortality_tier string, "
                                       "gender string, age bigint, department string, admission_type string, "
                                       "los_days bigint, heart_rate double, systolic_bp double, spo2 double, "
                                       "temperature double, diagnosis_name string")


def test_empty_queue(spark):
    empty = _pending(spark, [])
    assert EX.next_batch(empty).isEmpty()
    assert EX.merge_audit(EX.prompts(empty)).isEmpty()


def test_queue_filter_ignores_mortality_tier(spark):
    scores = spark.createDataFrame(
        [(1, 1, 1, 0.1, 0.1, 0.9, "Low", "Low", "High", None), (2, 1, 2, 0.5, 0.1, 0.1, "Medium", "Low", "Low", None),
         (3, 1, 3, 0.9, 0.9, 0.9, "High", "High", "High", "done")],
        "score_id long, patient_id long, admission_id long, readmission_risk double, deterioration_risk double, "
        "mortality_risk double, readmission_tier string, deterioration_tier string, mortality_tier string, "
        "ai_explanation string")
    pats = spark.createDataFrame([(1, "Male", dt.date(1950, 1, 1))], "patient_id long, gender string, date_of_birth date")
    adm = spark.createDataFrame([(i, "X", "Elective", dt.datetime(2001, 1, 1), None) for i in (1, 2, 3)],
                                "admission_id long, department string, admission_type string, "
                                "admission_date timestamp_ntz, discharge_date timestamp_ntz")
    vit = spark.createDataFrame([], "patient_id long, admission_id long, heart_rate double, systolic_bp double, "
                                    "spo2 double, temperature double")
    dia = spark.createDataFrame([], "admission_id long, diagnosis_name string")
    pend = EX.pending(scores, pats, adm, vit, dia)
    assert [r.admission_id for r in pend.collect()] == [2]
    pr = EX.prompts(pend).first()
    assert pr.status == "failed" and pr.prompt is None          # open stay: length of stay missing


def test_prompt_renders_python_text(spark):
    row = (5, 1, 2, 0.8888, 0.1, 0.0, "High", "Low", "Low", "Female", 70, "Oncology", "Emergency", 3,
           88.0, 120.5, None, 37.25, None)
    p = EX.prompts(_pending(spark, [row])).first()
    assert p.status == "ok"
    assert "70 years, Female; diagnosis None;" in p.prompt
    assert "SpO2 nan%" in p.prompt and "heart rate 88.0 bpm" in p.prompt
    assert "readmission High (0.89)" in p.prompt and "mortality Low (0.0)" in p.prompt


def test_merge_last_answer_wins_on_every_row(spark):
    scores = spark.createDataFrame([(1, 7, 70, None), (2, 7, 70, None), (3, 8, 80, "old")],
                                   "score_id long, patient_id long, admission_id long, ai_explanation string")
    answers = spark.createDataFrame([(7, 70, 1, "first"), (7, 70, 2, "second"), (9, 90, 1, "stray")],
                                    "patient_id long, admission_id long, seq int, explanation string")
    got = {r.score_id: r.ai_explanation for r in EX.merge_explanations(scores, answers).collect()}
    assert got == {1: "second", 2: "second", 3: "old"}
