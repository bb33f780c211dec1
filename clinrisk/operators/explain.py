"""Explanation work queue.

The original selects at-risk score rows without an explanation, renders a
prompt per row, sends it to a hosted language model one row at a time and
writes the answer back with an UPDATE.  Here: the queue and the prompts are
DataFrames over the whole pending set; the model call is outside the engine
(an external system fills a responses table); the write-back is a
de-duplicated keyed merge producing a new version of the score table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinrisk.functions.dates import age_years, los_days
from clinrisk.functions.risk import round_dec
from clinrisk.functions.text import py_float_text
from clinrisk.operators.star import as_of_date

#: Batch size of one explanation run (the original fetches 10 rows per run).
BATCH_SIZE = 10
AT_RISK = ("Medium", "High")

QUEUE_COLUMNS = ["score_id", "patient_id", "admission_id", "readmission_risk", "deterioration_risk",
                 "mortality_risk", "readmission_tier", "deterioration_tier", "mortality_tier", "gender",
                 "age", "department", "admission_type", "los_days", "heart_rate", "systolic_bp", "spo2",
                 "temperature", "diagnosis_name"]


def pending(scores: DataFrame, patients: DataFrame, admissions: DataFrame, vitals: DataFrame,
            diagnoses: DataFrame) -> DataFrame:
    """Score rows without an explanation whose readmission or
    deterioration tier is Medium/High (the mortality tier is not consulted),
    with patient, admission, vitals (by patient and admission) and diagnosis
    context; several diagnoses repeat a score row, as in the original."""
    r = scores.where(F.col("ai_explanation").isNull()
                     & (F.col("readmission_tier").isin(*AT_RISK) | F.col("deterioration_tier").isin(*AT_RISK)))
    r = r.select("score_id", "patient_id", "admission_id", "readmission_risk", "deterioration_risk",
                 "mortality_risk", "readmission_tier", "deterioration_tier", "mortality_tier")
    p = patients.select("patient_id", "gender", "date_of_birth")
    a = admissions.select("admission_id", "department", "admission_type", "admission_date", "discharge_date")
    v = vitals.select("patient_id", "admission_id", "heart_rate", "systolic_bp", "spo2", "temperature")
    d = diagnoses.select("admission_id", "diagnosis_name")
    j = (r.join(p, "patient_id").join(a, "admission_id")
         .join(v, ["patient_id", "admission_id"], "left").join(d, "admission_id", "left"))
    return j.select(
        "score_id", "patient_id", "admission_id", "readmission_risk", "deterioration_risk", "mortality_risk",
        "readmission_tier", "deterioration_tier", "mortality_tier", "gender",
        age_years(F.col("date_of_birth"), as_of_date()).alias("age"), "department", "admission_type",
        los_days(F.col("admission_date"), F.col("discharge_date")).alias("los_days"),
        "heart_rate", "systolic_bp", "spo2", "temperature", "diagnosis_name")


def queue_order():
    return [F.col("readmission_risk").desc(), F.col("deterioration_risk").desc(), F.col("score_id"),
            F.col("diagnosis_name").asc_nulls_first()]


def next_batch(pending_rows: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """One run's batch -- the highest readmission risks first (our
    order; the original takes any 10) -- numbered 1..n as ``score_id``.
    ``orderBy().limit()`` plans as a per-partition top-k; the numbering
    window only ever sees ``batch_size`` rows."""
    top = pending_rows.orderBy(*queue_order()).limit(batch_size)
    pos = F.row_number().over(Window.orderBy(*queue_order()))
    return top.withColumn("score_id", pos.cast("bigint")).select(*QUEUE_COLUMNS)


def _txt(c) -> F.Column:
    """A text cell as Python prints it: NULL -> 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def prompts(pending_rows: DataFrame) -> DataFrame:
    """The prompt text per pending row (our wording).  Rows whose age or
    length of stay is missing cannot be rendered (the original fails on
    them) and get status 'failed' and no prompt."""
    def score(tier_col, risk_col):
        return F.concat(_txt(F.col(tier_col)), F.lit(" ("), py_float_text(round_dec(F.col(risk_col), 2)), F.lit(")"))

    text = F.concat(
        F.lit("In two or three plain sentences for the treating doctor, explain this patient's risk "
              "and what to monitor.\n"),
        F.lit("Patient: "), F.col("age").cast("string"), F.lit(" years, "), _txt(F.col("gender")),
        F.lit("; diagnosis "), _txt(F.col("diagnosis_name")),
        F.lit("; department "), _txt(F.col("department")),
        F.lit("; admission "), _txt(F.col("admission_type")),
        F.lit("; stay "), F.col("los_days").cast("string"), F.lit(" days.\n"),
        F.lit("Vitals: heart rate "), py_float_text(F.col("heart_rate")), F.lit(" bpm, systolic BP "),
        py_float_text(F.col("systolic_bp")), F.lit(" mmHg, SpO2 "), py_float_text(F.col("spo2")),
        F.lit("%, temperature "), py_float_text(F.col("temperature")), F.lit(" C.\n"),
        F.lit("Risk: readmission "), score("readmission_tier", "readmission_risk"),
        F.lit(", deterioration "), score("deterioration_tier", "deterioration_risk"),
        F.lit(", mortality "), score("mortality_tier", "mortality_risk"), F.lit("."))
    ok = F.col("age").isNotNull() & F.col("los_days").isNotNull()
    return pending_rows.select(
        "score_id", "patient_id", "admission_id", "diagnosis_name",
        F.when(ok, text).alias("prompt"), F.when(ok, "ok").otherwise("failed").alias("status"))


def merge_explanations(scores: DataFrame, responses: DataFrame) -> DataFrame:
    """Set ``ai_explanation`` on *every* score row of each
    (patient, admission) with an answer; among several answers for one pair
    the highest sequence wins (ties: the greatest text).  Answers are
    reduced to one per pair before the join (map-side), and the join is a
    many-to-one left join keyed on the pair."""
    latest = (responses.where(F.col("explanation").isNotNull())
              .groupBy("patient_id", "admission_id")
              .agg(F.max_by("explanation", F.struct("seq", "explanation")).alias("new_explanation")))
    merged = scores.join(latest, ["patient_id", "admission_id"], "left")
    cols = [F.coalesce(F.col("new_explanation"), F.col("ai_explanation")).alias("ai_explanation")
            if c == "ai_explanation" else F.col(c) for c in scores.columns]
    return merged.select(*cols)


def merge_audit(prompt_rows: DataFrame) -> DataFrame:
    """Tally of rendered ('ok') and failed rows."""
    return prompt_rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def explained_sample(scores: DataFrame, n: int = 3) -> DataFrame:
    """I8: a few explained rows (lowest score ids; the original takes any 3)."""
    return (scores.where(F.col("ai_explanation").isNotNull()).orderBy("score_id").limit(n)
            .select("patient_id", "readmission_tier", "deterioration_tier", "ai_explanation"))
