"""Damaged tables give known non-zero counts; plans stay within their exchanges."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clinrisk.fixtures import FannedStar
from clinrisk.operators import features as FT
from clinrisk.operators import quality as Q
from clinrisk.plans.load import stored_star
from small import SMALL


@pytest.mark.parametrize("key,column", [("dq_checks_dirty", "violations"), ("dq_pk_dirty", "duplicate_rows"), ("dq_fk_dirty", "orphan_rows")])
def test_damage_is_counted(spark, key, column):
    rows = entry.queries()[key](spark, SMALL).collect()
    assert sum(r[column] > 0 for r in rows) >= 7


def test_fan_out_counts_equal_the_joined_children(spark):
    s = FannedStar(stored_star(spark, SMALL))
    got = {(r.admission_id, r.heart_rate): (r.diagnosis_count, r.medication_count, r.abnormal_labs) for r in FT.feature_frame(s).collect()}
    v = FT.VITAL_MEASURES
    fan = (s.admissions.where("discharge_date IS NOT NULL AND admission_id <= 200").select("admission_id", "patient_id")
           .join(s.vitals.select("admission_id", "patient_id", *v), ["admission_id", "patient_id"], "left")
           .join(s.diagnoses, "admission_id", "left").join(s.medications, "admission_id", "left")
           .join(s.labs.select("admission_id", "test_name"), "admission_id", "left"))
    want = fan.groupBy("admission_id", *v).agg(F.count_distinct("diagnosis_id").alias("d"), F.count_distinct("medication_id").alias("m"),
                                               F.count("test_name").alias("l")).collect()
    assert {(r.admission_id, r.heart_rate): (r.d, r.m, r.l) for r in want}.items() <= got.items()
    assert max(r.d for r in want) > 3 and max(r.l for r in want) > 50


@pytest.mark.parametrize("build,most", [(lambda s: FT.feature_frame(s), 9), (lambda s: Q.orphan_rows(s.tables()), 8)])
def test_exchanges_with_broadcast_off(spark, build, most):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build(stored_star(spark, SMALL))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    # an exchange that is read twice is printed twice: count each once
    made = set(re.findall(r"(?<!Reused)Exchange hashpartitioning\(.*plan_id=(\d+)", plan))
    assert 0 < len(made) <= most
