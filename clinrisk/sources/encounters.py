"""Hospital encounters (the raw CSV record) derived from the driver tables.

One encounter per order, joined to its customer.  The mapping is ours (the
original's CSV is not available); every column is a pure expression of the
order and customer row, so the frame grows with the tables and needs no
ordering or id assignment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinrisk import config as C
from clinrisk.sources.tables import read_table

BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
#: The mapped values in their fixed order, and one that no lookup knows.
CONDITIONS = [*C.DEPARTMENTS, "Migraine"]
MEDICATIONS = [*C.DOSAGE, "Metformin"]

#: Raw encounter schema: CSV header name -> (column, type).
RAW_COLUMNS = [
    ("Name", "name", T.StringType()),
    ("Age", "age", T.IntegerType()),
    ("Gender", "gender", T.StringType()),
    ("Blood Type", "blood_type", T.StringType()),
    ("Medical Condition", "medical_condition", T.StringType()),
    ("Date of Admission", "admission_date", T.TimestampNTZType()),
    ("Doctor", "doctor", T.StringType()),
    ("Insurance Provider", "insurance", T.StringType()),
    ("Billing Amount", "billing", T.DoubleType()),
    ("Room Number", "room", T.IntegerType()),
    ("Admission Type", "admission_type", T.StringType()),
    ("Discharge Date", "discharge_date", T.TimestampNTZType()),
    ("Medication", "medication", T.StringType()),
    ("Test Results", "test_results", T.StringType()),
]
ENCOUNTER_COLUMNS = ["enc_id"] + [c for _, c, _ in RAW_COLUMNS]


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def encounters_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    key, cust = F.col("o_orderkey"), F.col("c_custkey")
    h = F.floor(F.col("o_totalprice")).cast("bigint")
    nm = F.replace(F.col("c_name"), F.lit("#"), F.lit(" no "))
    return j.select(
        key.alias("enc_id"),
        F.when(key % 7 == 0, F.upper(nm)).when(key % 7 == 1, F.lower(nm)).otherwise(nm).alias("name"),
        (F.lit(18) + cust % 73).cast("int").alias("age"),
        F.when(cust % 2 == 0, "Male").otherwise("Female").alias("gender"),
        _pick(BLOOD_TYPES, cust % 8).alias("blood_type"),
        _pick(CONDITIONS, h % 7).alias("medical_condition"),
        F.col("o_orderdate").alias("admission_date"),
        F.concat(F.lit("Dr "), (key % 40).cast("string")).alias("doctor"),
        F.col("c_mktsegment").alias("insurance"),
        F.col("o_totalprice").alias("billing"),
        (F.lit(101) + key % 400).cast("int").alias("room"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Urgent")
         .when(F.col("o_orderpriority") == "2-HIGH", "Emergency").otherwise("Elective").alias("admission_type"),
        F.when(key % 50 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("o_orderdate") + F.make_dt_interval(days=(F.lit(1) + h % 30).cast("int")))
         .alias("discharge_date"),
        _pick(MEDICATIONS, h % 6).alias("medication"),
        F.when(key % 97 == 0, F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "F", "Normal")
         .when(F.col("o_orderstatus") == "P", "Abnormal").otherwise("Inconclusive").alias("test_results"),
    )


def encounters(spark, sf_dir: str) -> DataFrame:
    return encounters_from(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))


# SQL spelling of the same mapping (DuckDB), for the independent check.

def _sql_pick(values: list[str], idx: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{idx} + 1]"


SQL_ENCOUNTERS = f"""
  SELECT o.o_orderkey AS enc_id,
         CASE WHEN o.o_orderkey % 7 = 0 THEN upper(replace(c.c_name, '#', ' no '))
              WHEN o.o_orderkey % 7 = 1 THEN lower(replace(c.c_name, '#', ' no '))
              ELSE replace(c.c_name, '#', ' no ') END AS name,
         CAST(18 + c.c_custkey % 73 AS INTEGER) AS age,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         {_sql_pick(BLOOD_TYPES, 'c.c_custkey % 8')} AS blood_type,
         {_sql_pick(CONDITIONS, 'CAST(floor(o.o_totalprice) AS BIGINT) % 7')} AS medical_condition,
         o.o_orderdate AS admission_date,
         'Dr ' || CAST(o.o_orderkey % 40 AS VARCHAR) AS doctor,
         c.c_mktsegment AS insurance,
         o.o_totalprice AS billing,
         CAST(101 + o.o_orderkey % 400 AS INTEGER) AS room,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Urgent'
              WHEN o.o_orderpriority = '2-HIGH' THEN 'Emergency' ELSE 'Elective' END AS admission_type,
         CASE WHEN o.o_orderkey % 50 = 0 THEN NULL
              ELSE o.o_orderdate + to_days(CAST(1 + CAST(floor(o.o_totalprice) AS BIGINT) % 30 AS INTEGER)) END
              AS discharge_date,
         {_sql_pick(MEDICATIONS, 'CAST(floor(o.o_totalprice) AS BIGINT) % 6')} AS medication,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
              WHEN o.o_orderstatus = 'F' THEN 'Normal'
              WHEN o.o_orderstatus = 'P' THEN 'Abnormal' ELSE 'Inconclusive' END AS test_results
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
