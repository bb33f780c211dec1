import datetime as dt

import pytest

from clinrisk.operators import quality as Q
from clinrisk.operators.views import latest_risk, latest_vitals
from clinrisk.sources.sinks import KeyCollision, append_guarded
from clinrisk.session import scratch_path

T = dt.datetime


def test_latest_risk_nulls_first_then_highest_id(spark):
    scores = spark.createDataFrame(
        [(1, 10, T(2020, 1, 1)), (2, 10, None), (3, 10, T(2021, 1, 1)),
         (4, 20, T(2020, 1, 1)), (5, 20, T(2020, 1, 1)), (6, None, None)],
        "score_id long, patient_id long, scored_at timestamp_ntz")
    got = {r.patient_id: r.score_id for r in latest_risk(scores).collect()}
    assert got == {10: 2, 20: 5}


def test_latest_vitals_two_rows_same_time(spark):
    v = spark.createDataFrame([(1, 7, T(2020, 1, 1)), (2, 7, T(2020, 1, 1)), (3, 7, T(2019, 1, 1))],
                              "vital_id long, patient_id long, recorded_at timestamp_ntz")
    assert [r.vital_id for r in latest_vitals(v).collect()] == [2]


def test_latest_vitals_plan_limits_before_shuffle(spark):
    v = spark.range(0, 1000).selectExpr("id AS vital_id", "id % 3 AS patient_id",
                                         "timestamp_ntz'2020-01-01 00:00:00' AS recorded_at")
    plan = latest_vitals(v)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rule_violations_counts_and_null_passes_check(spark):
    pats = spark.createDataFrame(
        [("Ann", dt.date(2000, 1, 1), "Female", "A+", None, None, None),
         (None, None, "Robot", "AB++++", None, None, None),
         ("X" * 151, dt.date(2000, 1, 1), None, None, None, None, None)],
        "full_name string, date_of_birth date, gender string, blood_type string, contact_number string, "
        "email string, emergency_contact string")
    got = {r.rule: r.violations for r in Q.rule_violations({"patients": pats}).collect()}
    assert got["full_name_not_null"] == 1 and got["date_of_birth_not_null"] == 1
    assert got["gender_enum"] == 1          # NULL gender passes the CHECK
    assert got["blood_type_len"] == 1 and got["full_name_len"] == 1


def test_pk_and_fk_checks(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,)], "patient_id long")
    kids = spark.createDataFrame([(1, 1), (2, 3), (3, 3), (4, None)], "admission_id long, patient_id long")
    pk = {r.table_name: (r.duplicate_keys, r.duplicate_rows)
          for r in Q.duplicate_keys({"patients": parents, "admissions": kids}).collect()}
    assert pk == {"patients": (1, 2), "admissions": (0, 0)}
    fk = Q.orphan_rows({"patients": parents, "admissions": kids}).collect()
    assert [(r.table_name, r.fk_column, r.orphan_rows) for r in fk] == [("admissions", "patient_id", 2)]


def test_append_guarded_rejects_and_skips(spark):
    path = scratch_path(spark, "test-append")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    b = spark.createDataFrame([(2, "x"), (3, "c")], "k long, v string")
    assert append_guarded(a, path, "k") == 2
    with pytest.raises(KeyCollision):
        append_guarded(b, path, "k")
    assert append_guarded(b, path, "k", on_conflict="skip") == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(KeyCollision):
        append_guarded(spark.createDataFrame([(9, "a"), (9, "b")], "k long, v string"), path, "k")
