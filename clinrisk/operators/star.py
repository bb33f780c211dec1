"""Normalise raw encounters into the patient star schema.

patients      one row per distinct raw name (first encounter wins), ids in
              first-appearance order
admissions    one row per encounter; the patient is found through the
              title-cased name, the last patient id of that title wins
diagnoses, medications, vitals   one row per admission (same ids)
lab_results   4 or 5 rows per admission, ids admission-major

Synthetic values (birth dates, contact data, vitals, labs) are seeded draws
keyed by the encounter id (``functions.hashing``), so they are identical
however the data is partitioned or re-computed.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.functions.hashing import gauss, randint, uniform
from clinrisk.functions.lookups import lookup
from clinrisk.functions.text import money_text, title_case
from clinrisk.operators.ids import dense_ids
from clinrisk.operators.prefix import running_count
from clinrisk.sources.encounters import encounters



def as_of_date() -> Column:
    return F.lit(C.as_of().isoformat()).cast("date")


def as_of_ts() -> Column:
    return F.lit(C.as_of().isoformat() + " 00:00:00").cast("timestamp_ntz")


def patients_dim(enc: DataFrame) -> DataFrame:
    """De-duplicate raw names keeping the first encounter, number them
    in order of first appearance and add the synthetic contact columns."""
    first = enc.groupBy("name").agg(
        F.min("enc_id").alias("first_enc"),
        F.min_by("age", "enc_id").alias("age"),
        F.min_by("gender", "enc_id").alias("gender"),
        F.min_by("blood_type", "enc_id").alias("blood_type"),
    )
    numbered = dense_ids(first, ["first_enc"], "patient_id")
    rid = F.col("first_enc")
    full_name = title_case(F.col("name"))
    dob = F.make_date(
        (F.year(as_of_date()) - F.col("age")).cast("int"),
        (F.lit(1) + F.floor(uniform("dob", rid, 0) * 12)).cast("int"),
        (F.lit(1) + F.floor(uniform("dob", rid, 1) * 28)).cast("int"),
    )
    (p1, p2, p3) = C.PHONE_RANGES
    phone = F.format_string("+1-%d-%d-%d", randint("contact", rid, 0, *p1),
                            randint("contact", rid, 1, *p2), randint("contact", rid, 2, *p3))
    address = F.concat(randint("contact", rid, 3, *C.ADDRESS_NUMBER_RANGE).cast("string"),
                       F.lit(C.ADDRESS_SUFFIX))
    return numbered.select(
        "patient_id",
        full_name.alias("full_name"),
        dob.alias("date_of_birth"),
        "gender",
        "blood_type",
        phone.alias("contact_number"),
        F.concat(F.lower(F.replace(full_name, F.lit(" "), F.lit(""))), F.lit(C.EMAIL_DOMAIN)).alias("email"),
        address.alias("address"),
        F.lit(C.EMERGENCY_CONTACT).alias("emergency_contact"),
        as_of_ts().alias("created_at"),
    )


def name_lookup(patients: DataFrame) -> DataFrame:
    """Title-cased name -> patient id; among case variants the last
    (highest) id wins.  One row per name, so joins against it never fan out."""
    return patients.groupBy("full_name").agg(F.max("patient_id").alias("patient_id"))


def admissions_base(enc: DataFrame, patients: DataFrame) -> DataFrame:
    """Encounters with admission ids (row order) and the looked-up patient id.
    Every per-admission fact table is a projection of this frame."""
    numbered = dense_ids(enc, ["enc_id"], "admission_id", once=False)
    keyed = numbered.withColumn("full_name", title_case(F.col("name")))
    return keyed.join(name_lookup(patients), "full_name", "left")


def admissions_fact(base: DataFrame) -> DataFrame:
    cond = F.col("medical_condition")
    ward = F.concat(F.lit(C.WARD_PREFIX),
                    F.char((F.lit(65) + F.pmod(F.col("room"), F.lit(C.WARD_COUNT))).cast("bigint")))
    old, new = C.ADMISSION_TYPE_REPLACE
    adm_type = F.when(F.col("admission_type") == old, new).otherwise(F.col("admission_type"))
    notes = F.concat(F.col("insurance"), F.lit(C.NOTES_SEPARATOR), money_text(F.col("billing")))
    return base.select(
        "admission_id", "patient_id", "admission_date", "discharge_date",
        lookup(C.DEPARTMENTS, cond, C.DEFAULT_DEPARTMENT).alias("department"),
        F.when(F.col("room").isNotNull(), ward).alias("ward"),
        adm_type.alias("admission_type"),
        lookup(C.DISCHARGE_STATUS, F.col("test_results"), C.DEFAULT_DISCHARGE).alias("discharge_status"),
        F.col("doctor").alias("attending_doctor"),
        notes.alias("notes"),
    )


def diagnoses_fact(base: DataFrame) -> DataFrame:
    return base.select(
        F.col("admission_id").alias("diagnosis_id"), "admission_id", "patient_id",
        lookup(C.ICD10, F.col("medical_condition")).alias("icd10_code"),
        F.col("medical_condition").alias("diagnosis_name"),
        F.lit(C.DIAGNOSIS_TYPE).alias("diagnosis_type"),
        F.col("admission_date").alias("diagnosed_at"),
    )


def medications_fact(base: DataFrame) -> DataFrame:
    drug = F.col("medication")
    return base.select(
        F.col("admission_id").alias("medication_id"), "patient_id", "admission_id",
        drug.alias("drug_name"),
        lookup(C.DOSAGE, drug, C.DEFAULT_DOSAGE).alias("dosage"),
        F.lit(C.FREQUENCY).alias("frequency"),
        lookup(C.ROUTE, drug, C.DEFAULT_ROUTE).alias("route"),
        F.to_date("admission_date").alias("start_date"),
        F.to_date("discharge_date").alias("end_date"),
        F.col("doctor").alias("prescribed_by"),
    )


def _choose(flag: Column, when_true: tuple, when_false: tuple) -> tuple[Column, Column]:
    return (F.when(flag, when_true[0]).otherwise(when_false[0]),
            F.when(flag, when_true[1]).otherwise(when_false[1]))


def bmi(weight: Column, height: Column) -> Column:
    """Weight / (height/100)^2 rounded to 2 places through a decimal (as a
    NUMERIC cast would), NULL unless height > 0."""
    ratio = weight / ((height / 100.0) * (height / 100.0))
    return F.when(height > 0, F.round(ratio.cast("decimal(18,10)"), 2).cast("double"))


def vitals_fact(base: DataFrame) -> DataFrame:
    """Eight condition-dependent gaussian vitals per admission,
    clamped and rounded to one decimal, plus the generated ``bmi``."""
    rid = F.col("enc_id")
    abnormal = F.coalesce(F.col("test_results") == "Abnormal", F.lit(False))
    cond = F.col("medical_condition")
    hyper = F.coalesce(cond == "Hypertension", F.lit(False))
    asthma_abn = F.coalesce(cond == "Asthma", F.lit(False)) & abnormal
    obese = F.coalesce(cond == "Obesity", F.lit(False))

    hr = gauss("vitals1", rid, 0, *_choose(abnormal, *C.VITALS_HR))
    sbp = gauss("vitals1", rid, 1, *_choose(hyper, *C.VITALS_SBP))
    dbp = sbp - gauss("vitals2", rid, 0, *C.VITALS_DBP_GAP)
    spo2 = gauss("vitals2", rid, 1, *_choose(asthma_abn, *C.VITALS_SPO2))
    temp = gauss("vitals3", rid, 0, *_choose(abnormal, *C.VITALS_TEMP))
    rr = gauss("vitals3", rid, 1, *_choose(abnormal, *C.VITALS_RR))
    wt = gauss("vitals4", rid, 0, *_choose(obese, *C.VITALS_WEIGHT))
    ht = gauss("vitals4", rid, 1, *C.VITALS_HEIGHT)
    raw = {"heart_rate": hr, "systolic_bp": sbp, "diastolic_bp": dbp, "temperature": temp,
           "spo2": spo2, "respiratory_rate": rr, "weight_kg": wt, "height_cm": ht}

    def clamp(name: str, x: Column) -> Column:
        v = F.greatest(F.lit(C.VITALS_FLOOR[name]), x)
        if name == "spo2":
            v = F.least(F.lit(C.SPO2_CAP), v)
        return F.round(v, 1).alias(name)

    measured = base.select(
        F.col("admission_id").alias("vital_id"), "patient_id", "admission_id",
        F.col("admission_date").alias("recorded_at"),
        *[clamp(n, x) for n, x in raw.items()])
    return measured.withColumn("bmi", bmi(F.col("weight_kg"), F.col("height_cm")))


def lab_templates() -> Column:
    return F.array(*[
        F.struct(F.lit(i + 1).alias("ord"), F.lit(name).alias("test_name"),
                 F.lit(float(lo)).alias("reference_min"), F.lit(float(hi)).alias("reference_max"),
                 F.lit(unit).alias("unit"), F.lit(only).cast("string").alias("only_for"))
        for i, (name, lo, hi, unit, only) in enumerate(C.LAB_TEMPLATES)])


def is_abnormal(value: Column, lo: Column, hi: Column) -> Column:
    """Below the minimum or above the maximum (three-valued)."""
    return (value < lo) | (value > hi)


def labs_fact(base: DataFrame) -> DataFrame:
    """Expand each admission by the lab templates (HbA1c only for
    Diabetes) -- a narrow ``explode`` of a literal array, no join -- draw the
    value, and number the rows admission-major, template-minor."""
    abnormal = F.coalesce(F.col("test_results") == "Abnormal", F.lit(False))
    t = F.col("t")
    kept = base.select("enc_id", "admission_id", "patient_id", "admission_date", "medical_condition", abnormal.alias("abn"))

    def expand(rows: DataFrame) -> DataFrame:
        made = rows.select("*", F.explode(lab_templates()).alias("t")).where(t["only_for"].isNull() | (F.col("medical_condition") == t["only_for"]))
        return made.select("enc_id", "admission_id", "patient_id", "admission_date", "abn", t["ord"].alias("ord"))
    # Sorted and numbered before the draws, as admissions; the template is known by its number.
    expanded = running_count(kept, ["admission_id"], "__before", once=False, expand=expand)
    expanded = expanded.select("*", (F.col("__before") + 1).alias("lab_id"), F.get(lab_templates(), F.col("ord") - 1).alias("t"))
    lo = F.when(F.col("abn"), t["reference_max"]).otherwise(t["reference_min"])
    hi = F.when(F.col("abn"), t["reference_max"] * C.ABNORMAL_LAB_FACTOR).otherwise(t["reference_max"])
    u = uniform("lab:", F.concat(F.col("enc_id").cast("string"), F.lit(":"), t["test_name"]), 0)
    numbered = expanded.select(
        "lab_id", "admission_id", "patient_id", t["test_name"].alias("test_name"),
        F.round(lo + (hi - lo) * u, 2).alias("test_value"),
        t["unit"].alias("unit"), t["reference_min"].alias("reference_min"),
        t["reference_max"].alias("reference_max"),
        F.col("admission_date").alias("collected_at"))
    return numbered.select(
        "lab_id", "patient_id", "admission_id", "test_name", "test_value", "unit",
        "reference_min", "reference_max",
        is_abnormal(F.col("test_value"), F.col("reference_min"), F.col("reference_max")).alias("is_abnormal"),
        "collected_at")


class Star:
    """The normalised tables for one input folder, built lazily on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, enc: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._enc = enc

    @cached_property
    def encounters(self) -> DataFrame:
        return self._enc if self._enc is not None else encounters(self.spark, self.sf_dir)

    @cached_property
    def patients(self) -> DataFrame:
        return patients_dim(self.encounters)

    @cached_property
    def base(self) -> DataFrame:
        return admissions_base(self.encounters, self.patients)

    @cached_property
    def admissions(self) -> DataFrame:
        return admissions_fact(self.base)

    @cached_property
    def diagnoses(self) -> DataFrame:
        return diagnoses_fact(self.base)

    @cached_property
    def medications(self) -> DataFrame:
        return medications_fact(self.base)

    @cached_property
    def vitals(self) -> DataFrame:
        return vitals_fact(self.base)

    @cached_property
    def labs(self) -> DataFrame:
        return labs_fact(self.base)

    def tables(self) -> dict[str, DataFrame]:
        return {"patients": self.patients, "admissions": self.admissions, "diagnoses": self.diagnoses,
                "vitals": self.vitals, "lab_results": self.labs, "medications": self.medications}
