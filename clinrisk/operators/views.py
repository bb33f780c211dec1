"""Latest-record views and the patient risk summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """First row per ``key`` in ``order`` (``DISTINCT ON`` semantics, with a
    total order so ties are deterministic).  ``row_number() = 1`` plans as a
    WindowGroupLimit: each map task keeps only its best row per key before
    the shuffle, so a key with a third of all rows ships one row per task."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_vitals(vitals: DataFrame) -> DataFrame:
    """Newest reading per patient (NULL time sorts first, as a
    descending PostgreSQL sort would; highest id breaks ties)."""
    return latest_per_key(vitals.where(F.col("patient_id").isNotNull()), "patient_id",
                          [F.col("recorded_at").desc_nulls_first(), F.col("vital_id").desc()])


def latest_risk(scores: DataFrame) -> DataFrame:
    """Newest score per patient; NULL ``scored_at`` first, then highest
    ``score_id`` (the original's tie order is arbitrary)."""
    return latest_per_key(scores.where(F.col("patient_id").isNotNull()), "patient_id",
                          [F.col("scored_at").desc_nulls_first(), F.col("score_id").desc()])


SUMMARY_COLUMNS = [
    "patient_id", "full_name", "date_of_birth", "gender", "admission_id", "department",
    "admission_type", "discharge_status", "heart_rate", "systolic_bp", "spo2", "bmi",
    "readmission_risk", "deterioration_risk", "mortality_risk", "readmission_tier",
    "deterioration_tier", "mortality_tier", "top_features", "ai_explanation", "scored_at",
]


def patient_risk_summary(patients: DataFrame, admissions: DataFrame, vitals: DataFrame,
                         scores: DataFrame) -> DataFrame:
    """Every patient with each of their admissions (or one row without),
    the latest vitals and the latest risk score repeated on each row.

    ``patients LEFT JOIN admissions`` is split into an inner join plus the
    patients that have no admission (anti join against the *distinct*
    admitting patient ids, pre-aggregated map-side).  Both pieces keep the
    many side on the left of the later many-to-one joins, where adaptive
    execution can split a skewed patient's partition."""
    pat = patients.select("patient_id", "full_name", "date_of_birth", "gender")
    adm = admissions.select("patient_id", "admission_id", "department", "admission_type", "discharge_status")
    with_adm = adm.join(pat, "patient_id")
    admitted = adm.where(F.col("patient_id").isNotNull()).select("patient_id").distinct()
    without = (pat.join(admitted, "patient_id", "left_anti")
               .select("patient_id", F.lit(None).cast("bigint").alias("admission_id"),
                       F.lit(None).cast("string").alias("department"),
                       F.lit(None).cast("string").alias("admission_type"),
                       F.lit(None).cast("string").alias("discharge_status"),
                       "full_name", "date_of_birth", "gender"))
    rows = with_adm.unionByName(without)
    lv = latest_vitals(vitals).select("patient_id", "heart_rate", "systolic_bp", "spo2", "bmi")
    lr = latest_risk(scores).select("patient_id", "readmission_risk", "deterioration_risk", "mortality_risk",
                                    "readmission_tier", "deterioration_tier", "mortality_tier",
                                    "top_features", "ai_explanation", "scored_at")
    return rows.join(lv, "patient_id", "left").join(lr, "patient_id", "left").select(*SUMMARY_COLUMNS)
