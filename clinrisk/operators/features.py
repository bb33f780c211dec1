"""Per-admission feature frame (the flagship query) and its parts.

The original builds the frame with one statement: patients JOIN admissions,
LEFT JOIN vitals, diagnoses, medications and lab results (a many-to-many
fan-out), GROUP BY 16 keys, COUNT(DISTINCT ...), a conditional-max pivot and
a correlated EXISTS for 30-day readmission.  Here the rows of all child
tables are tagged, unioned and reduced to one row per admission by a single
aggregation (partial on the map side); the patient's columns are joined while
rows are narrow; one hash partitioning on ``admission_id`` then serves every
further join; and the fan-out-dependent ``abnormal_labs`` count is recovered
arithmetically.  Nothing ever materialises the product of the children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.functions.dates import age_years, los_days
from clinrisk.operators.prefix import prefix_scan
from clinrisk.operators.star import Star, as_of_date

VITAL_MEASURES = ["heart_rate", "systolic_bp", "diastolic_bp", "temperature", "spo2", "respiratory_rate"]
LAB_PIVOT = [("Creatinine", "creatinine"), ("HbA1c", "hba1c"), ("WBC", "wbc"),
             ("Hemoglobin", "hemoglobin"), ("Sodium", "sodium")]


def readmission_flags(admissions: DataFrame, days: int = C.READMIT_DAYS, once: bool = False) -> DataFrame:
    """for each discharged admission, 1 if the same patient has an
    admission in (discharge, discharge + ``days`` days], else 0.

    A scan, never a pairwise join: a patient's discharges and admissions are
    ordered newest first (at equal times discharges first, as the start is
    exclusive), and the running minimum of the admissions passed is the next
    one after the discharge.  The minimum is carried over range partitions
    (``prefix_scan``), so even one day of one patient may hold most rows."""
    null = F.lit(None)
    sides = F.explode(F.array(
        F.struct(F.col("discharge_date").alias("ts"), F.lit(1).alias("k"), F.col("admission_id").alias("of"), null.cast("timestamp_ntz").alias("arrival")),
        F.struct(F.col("admission_date").alias("ts"), F.lit(0).alias("k"), null.cast("bigint").alias("of"), F.col("admission_date").alias("arrival"))))
    events = admissions.select("patient_id", sides.alias("e")).select("patient_id", "e.*").where("ts IS NOT NULL")
    # NULL patients never match: their discharges skip the scan.
    nobody = events.where("patient_id IS NULL AND k = 1").select(F.col("of").alias("admission_id"), "patient_id", F.lit(0).cast("bigint").alias("readmitted_30d"))
    order = [F.col("ts").desc(), F.col("k").desc(), F.col("of").asc()]
    passed = prefix_scan(events.where("patient_id IS NOT NULL"), ["patient_id"], order, {"next": ("min", F.col("arrival"))}, once=once)
    soon = F.col("next") <= F.col("ts") + F.make_dt_interval(days=F.lit(days))
    flags = passed.where("k = 1").select(F.col("of").alias("admission_id"), "patient_id", F.when(soon, 1).otherwise(0).cast("bigint").alias("readmitted_30d"))
    return flags.unionByName(nobody)


def vitals_groups(vitals: DataFrame) -> DataFrame:
    """the 16-key GROUP BY keeps one output row per distinct vitals
    reading of an admission; count the readings behind each.  Dealt out by
    admission, so that the join on the admission needs no further exchange."""
    return (vitals.where(F.col("patient_id").isNotNull() & F.col("admission_id").isNotNull()).repartition("admission_id")
            .groupBy("patient_id", "admission_id", *VITAL_MEASURES).agg(F.count(F.lit(1)).alias("n_vital_rows")))


def child_summary(diagnoses: DataFrame, medications: DataFrame, labs: DataFrame) -> DataFrame:
    """F7/F8/F9b without fan-out: per admission the number of diagnoses and
    medications (their ids are unique, so a plain count is the distinct
    count), the conditional-max pivot of the five tests, the lab rows and the
    true abnormal count; one aggregation over the tagged rows of all three."""
    null = F.lit(None)
    rows = (diagnoses.select("admission_id", F.lit("d").alias("kind"), null.cast("string").alias("test_name"),
                             null.cast("double").alias("test_value"), null.cast("boolean").alias("is_abnormal"))
            .union(medications.select("admission_id", F.lit("m"), null.cast("string"), null.cast("double"), null.cast("boolean")))
            .union(labs.select("admission_id", F.lit("l"), "test_name", "test_value", "is_abnormal")))
    pivots = [F.max(F.when(F.col("test_name") == test, F.col("test_value"))).alias(col) for test, col in LAB_PIVOT]
    return (rows.where(F.col("admission_id").isNotNull()).groupBy("admission_id")
            .agg(F.count_if(F.col("kind") == "d").alias("diagnosis_count"), F.count_if(F.col("kind") == "m").alias("medication_count"),
                 *pivots, F.count("test_name").alias("n_lab_names"),
                 F.count_if(F.col("is_abnormal")).cast("bigint").alias("abnormal_lab_count")))


def lab_summary(labs: DataFrame) -> DataFrame:
    """F8/F9b alone: conditional-max pivot of the five tests, lab-row count and
    true abnormal count per admission, in one aggregation."""
    pivots = [F.max(F.when(F.col("test_name") == test, F.col("test_value"))).alias(col)
              for test, col in LAB_PIVOT]
    return (labs.where(F.col("admission_id").isNotNull()).groupBy("admission_id")
            .agg(*pivots, F.count("test_name").alias("n_lab_names"),
                 F.count_if(F.col("is_abnormal")).cast("bigint").alias("abnormal_lab_count")))


def feature_frame(s: Star, keep_extra: bool = False) -> DataFrame:
    adm = (s.admissions.where(F.col("discharge_date").isNotNull())
           .select("admission_id", "patient_id", "department", "admission_type", "discharge_status",
                   "admission_date", "discharge_date"))
    pat = s.patients.select("patient_id", "date_of_birth", "gender", "blood_type")
    flags = readmission_flags(s.admissions).select("admission_id", "readmitted_30d")

    # The patient's columns first, while rows are narrow; then one partitioning by admission serves all joins.
    j = (adm.join(pat, "patient_id")
         .join(child_summary(s.diagnoses, s.medications, s.labs), "admission_id", "left")
         .join(flags, "admission_id", "left")
         .join(vitals_groups(s.vitals), ["patient_id", "admission_id"], "left"))

    fan = (F.coalesce(F.col("n_lab_names"), F.lit(0))
           * F.coalesce(F.col("n_vital_rows"), F.lit(1))
           * F.greatest(F.coalesce(F.col("diagnosis_count"), F.lit(0)), F.lit(1))
           * F.greatest(F.coalesce(F.col("medication_count"), F.lit(0)), F.lit(1)))
    status = F.col("discharge_status")
    cols = [
        F.col("patient_id"),
        age_years(F.col("date_of_birth"), as_of_date()).alias("age"),
        F.col("gender"), F.col("blood_type"),
        F.col("admission_id"), F.col("department"), F.col("admission_type"), status,
        los_days(F.col("admission_date"), F.col("discharge_date")).alias("los_days"),
        *[F.col(m) for m in VITAL_MEASURES],
        F.coalesce(F.col("diagnosis_count"), F.lit(0)).cast("bigint").alias("diagnosis_count"),
        F.coalesce(F.col("medication_count"), F.lit(0)).cast("bigint").alias("medication_count"),
        *[F.col(c) for _, c in LAB_PIVOT],
        fan.cast("bigint").alias("abnormal_labs"),
        F.coalesce(F.col("readmitted_30d"), F.lit(0)).cast("bigint").alias("readmitted_30d"),
        F.when(status == "Transferred", 1).otherwise(0).cast("bigint").alias("deteriorated"),
        F.when(status == "Deceased", 1).otherwise(0).cast("bigint").alias("mortality"),
    ]
    if keep_extra:
        cols.append(F.coalesce(F.col("abnormal_lab_count"), F.lit(0)).alias("abnormal_lab_count"))
    return j.select(*cols)


def patient_ages(s: Star) -> DataFrame:
    return s.patients.select("patient_id", "date_of_birth",
                             age_years(F.col("date_of_birth"), as_of_date()).alias("age"))


def lengths_of_stay(s: Star) -> DataFrame:
    return s.admissions.select("admission_id", "admission_date", "discharge_date",
                               los_days(F.col("admission_date"), F.col("discharge_date")).alias("los_days"))


def _tagged(diagnoses: DataFrame, medications: DataFrame) -> DataFrame:
    rows = diagnoses.select("admission_id", F.lit("d").alias("kind"), F.col("diagnosis_id").alias("id"))
    return rows.union(medications.select("admission_id", F.lit("m"), "medication_id")).where("admission_id IS NOT NULL")


def _with_counts(s: Star, counts: DataFrame) -> DataFrame:
    adm = s.admissions.where(F.col("discharge_date").isNotNull()).select("admission_id")
    return adm.join(counts, "admission_id", "left").select(
        "admission_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("diagnosis_count", "medication_count")])


def distinct_counts(s: Star) -> DataFrame:
    """F7 where the keys are known to be unique: plain counts, one aggregation."""
    return _with_counts(s, _tagged(s.diagnoses, s.medications).groupBy("admission_id").agg(
        F.count_if(F.col("kind") == "d").alias("diagnosis_count"), F.count_if(F.col("kind") == "m").alias("medication_count")))


def distinct_counts_direct(s: Star) -> DataFrame:
    """F7 as it is written, two COUNT(DISTINCT) in one aggregate, trusting no
    key: the children are tagged and unioned instead of joined, so the two
    never multiply, and ids are made distinct before an admission's rows meet."""
    each = [F.count_distinct(F.when(F.col("kind") == kind, F.col("id"))).alias(name) for kind, name in (("d", "diagnosis_count"), ("m", "medication_count"))]
    return _with_counts(s, _tagged(s.diagnoses, s.medications).groupBy("admission_id").agg(*each))


def lab_pivot(s: Star) -> DataFrame:
    return lab_summary(s.labs).select("admission_id", *[c for _, c in LAB_PIVOT])


def abnormal_lab_counts(s: Star) -> DataFrame:
    return lab_summary(s.labs).select("admission_id", "n_lab_names", "abnormal_lab_count") \
        .withColumn("n_lab_names", F.col("n_lab_names").cast("bigint"))
