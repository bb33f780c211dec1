"""Feature-frame edge cases: readmission window bounds, fan-out arithmetic."""

import datetime as dt
import random


from pyspark.sql import functions as F

from clinrisk.operators.features import feature_frame, readmission_flags
from clinrisk.operators.prefix import prefix_scan

T = dt.datetime


def _adm(spark, rows):
    return spark.createDataFrame(rows, "admission_id long, patient_id long, admission_date timestamp_ntz, "
                                       "discharge_date timestamp_ntz")


def test_readmission_window_bounds(spark):
    d = T(2020, 1, 10)
    rows = [
        (1, 1, T(2020, 1, 1), d), (2, 1, d, T(2020, 1, 11)),                 # same instant: not a readmission
        (3, 2, T(2020, 1, 1), d), (4, 2, d + dt.timedelta(days=30), None),  # exactly 30 days: readmission
        (5, 3, T(2020, 1, 1), d), (6, 3, d + dt.timedelta(days=30, seconds=1), None),  # just over
        (7, 4, T(2020, 1, 1), None),                                         # never discharged: no row
        (8, 5, T(2020, 1, 1), d), (9, 5, T(2020, 1, 5), T(2020, 2, 20)),   # earlier admission only
        (10, 6, T(2020, 1, 30), T(2020, 2, 1)), (11, 6, T(2020, 3, 2), T(2020, 3, 3)),  # crosses buckets, 30 d
        (12, None, T(2020, 1, 1), d), (13, None, T(2020, 1, 12), d),        # unknown patient never matches
    ]
    got = {r.admission_id: r.readmitted_30d for r in readmission_flags(_adm(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 5: 0, 8: 0, 9: 0, 10: 1, 11: 0, 12: 0, 13: 0}


def test_readmission_matches_exists_on_random_histories(spark):
    rnd = random.Random(7)
    rows, aid = [], 0
    for pid in range(40):
        t = T(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 50))
        for _ in range(rnd.randint(1, 25)):
            aid += 1
            stay = dt.timedelta(days=rnd.choice([0, 1, 3, 30]), hours=rnd.choice([0, 5]))
            rows.append((aid, pid, t, None if rnd.random() < 0.05 else t + stay))
            t = t + dt.timedelta(days=rnd.choice([0, 1, 10, 29, 30, 31, 45, 90]))
    adm = _adm(spark, rows)
    adm.createOrReplaceTempView("adm_rand")
    expected = {r[0]: r[1] for r in spark.sql("""
        SELECT a.admission_id, CASE WHEN EXISTS (SELECT 1 FROM adm_rand b WHERE b.patient_id = a.patient_id
               AND b.admission_date > a.discharge_date
               AND b.admission_date <= a.discharge_date + INTERVAL 30 DAYS) THEN 1 ELSE 0 END
        FROM adm_rand a WHERE a.discharge_date IS NOT NULL""").collect()}
    got = {r.admission_id: r.readmitted_30d for r in readmission_flags(adm).collect()}
    assert got == expected


def test_one_patient_day_spans_many_tasks(spark):
    """Every row of one patient and one day: the minimum is carried over partitions."""
    day = T(2020, 5, 5)
    rows = [(i, 1, day + dt.timedelta(seconds=7 * i % 40_000), day + dt.timedelta(seconds=(7 * i % 40_000) + 1 + i % 5)) for i in range(4000)]
    rows += [(5000, 1, day + dt.timedelta(days=20), None)]
    adm = _adm(spark, rows)
    got = {r.admission_id: r.readmitted_30d for r in readmission_flags(adm).collect()}
    assert got == {i: 1 for i in range(4000)}
    scanned = prefix_scan(adm.where("discharge_date IS NOT NULL"), ["patient_id"], ["admission_date", "admission_id"],
                          {"last": ("max", F.col("admission_id")), "least": ("min", F.col("admission_id")), "n": ("sum", F.lit(1))})
    parts = scanned.groupBy(F.spark_partition_id()).count().collect()
    ordered = sorted(scanned.collect(), key=lambda r: (r.admission_date, r.admission_id))
    assert len(parts) > 1 and [r.n for r in ordered] == list(range(4000))
    ids = [r.admission_id for r in ordered]
    assert ordered[0].last is None and [r.last for r in ordered[1:]] == [max(ids[:i]) for i in range(1, 4000)]
    assert [r.least for r in ordered[1:]] == [min(ids[:i]) for i in range(1, 4000)]


class _Star:
    def __init__(self, **tables):
        self.__dict__.update(tables)


def test_feature_frame_fan_out_and_vitals_groups(spark):
    """Two distinct vitals rows make two output rows; abnormal_labs is the
    fan-out product; counts are distinct counts."""
    adm = spark.createDataFrame(
        [(1, 1, T(2020, 1, 1), T(2020, 1, 3), "Cardiology", "Emergency", "Transferred"),
         (2, 1, T(2020, 2, 1), T(2020, 2, 2), "Oncology", "Elective", "Recovered"),
         (3, 2, T(2020, 1, 1), None, "Oncology", "Elective", "Recovered")],
        "admission_id long, patient_id long, admission_date timestamp_ntz, discharge_date timestamp_ntz, "
        "department string, admission_type string, discharge_status string")
    pat = spark.createDataFrame([(1, dt.date(1950, 1, 1), "Male", "A+"), (2, dt.date(1960, 1, 1), "Female", "O-")],
                                "patient_id long, date_of_birth date, gender string, blood_type string")
    vit = spark.createDataFrame(
        [(1, 1, 1, 80.0, 120.0, 80.0, 37.0, 97.0, 16.0), (2, 1, 1, 90.0, 0.0, 80.0, 37.0, 97.0, 16.0)],
        "vital_id long, patient_id long, admission_id long, heart_rate double, systolic_bp double, "
        "diastolic_bp double, temperature double, spo2 double, respiratory_rate double")
    dia = spark.createDataFrame([(1, 1, 1, "A"), (2, 1, 1, "B")],
                                "diagnosis_id long, admission_id long, patient_id long, diagnosis_name string")
    med = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 1)],
                                "medication_id long, admission_id long, patient_id long")
    labs = spark.createDataFrame(
        [(1, 1, "WBC", 12.0, True), (2, 1, "Sodium", 140.0, False), (3, 2, "WBC", 5.0, False)],
        "lab_id long, admission_id long, test_name string, test_value double, is_abnormal boolean")
    s = _Star(admissions=adm, patients=pat, vitals=vit, diagnoses=dia, medications=med, labs=labs)
    rows = sorted(feature_frame(s, keep_extra=True).collect(), key=lambda r: (r.admission_id, r.heart_rate or 0))
    assert [(r.admission_id, r.heart_rate) for r in rows] == [(1, 80.0), (1, 90.0), (2, None)]
    r1 = rows[0]
    assert (r1.diagnosis_count, r1.medication_count) == (2, 3)
    assert r1.abnormal_labs == 2 * 1 * 2 * 3          # labs x vitals-in-group x diagnoses x medications
    assert r1.abnormal_lab_count == 1
    assert (r1.wbc, r1.sodium, r1.hba1c) == (12.0, 140.0, None)
    assert r1.deteriorated == 1 and r1.readmitted_30d == 1 and r1.los_days == 2  # next stay 29 days on
    r3 = rows[2]
    assert (r3.diagnosis_count, r3.medication_count, r3.abnormal_labs, r3.wbc) == (0, 0, 1, 5.0)
