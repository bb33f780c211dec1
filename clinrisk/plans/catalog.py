"""SQL text over the schema (A4): the tables and the three views by name.

``Catalog`` registers a set of tables as temporary views of the session, and
the three views as SQL text over them, so that ``sql`` turns any query into a
DataFrame that the optimizer plans as a whole.  A table may be given by the
function that builds it: it is built once a text, or a view of it, names it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinrisk import config as C
from clinrisk.operators.features import LAB_PIVOT, VITAL_MEASURES

_NEWEST = """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY {at} DESC NULLS FIRST, {key} DESC) AS place
  FROM {table} WHERE patient_id IS NOT NULL) WHERE place = 1"""

#: Name -> SQL of the views, in the order of their use.
VIEWS = {
    "v_latest_vitals": f"SELECT * EXCEPT (place) FROM ({_NEWEST.format(at='recorded_at', key='vital_id', table='vitals')})",
    "v_latest_risk": f"SELECT * EXCEPT (place) FROM ({_NEWEST.format(at='scored_at', key='score_id', table='risk_scores')})",
    "v_patient_risk_summary": """
SELECT p.patient_id, p.full_name, p.date_of_birth, p.gender, a.admission_id, a.department, a.admission_type, a.discharge_status,
       v.heart_rate, v.systolic_bp, v.spo2, v.bmi, r.readmission_risk, r.deterioration_risk, r.mortality_risk,
       r.readmission_tier, r.deterioration_tier, r.mortality_tier, r.top_features, r.ai_explanation, r.scored_at
FROM patients p
LEFT JOIN admissions a USING (patient_id)
LEFT JOIN v_latest_vitals v USING (patient_id)
LEFT JOIN v_latest_risk r USING (patient_id)""",
}


def feature_sql() -> str:
    """The feature frame (F) as one SQL text.  Children are summed up before they are joined, so that they never multiply."""
    pivots = ", ".join(f"max(test_value) FILTER (WHERE test_name = '{test}') AS {name}" for test, name in LAB_PIVOT)
    measures = ", ".join(VITAL_MEASURES)
    as_of = f"DATE '{C.as_of().isoformat()}'"
    return f"""
WITH readings AS (SELECT patient_id, admission_id, {measures}, count(*) AS n_readings FROM vitals GROUP BY ALL),
     diagnosed AS (SELECT admission_id, count(DISTINCT diagnosis_id) AS n FROM diagnoses GROUP BY admission_id),
     medicated AS (SELECT admission_id, count(DISTINCT medication_id) AS n FROM medications GROUP BY admission_id),
     tested AS (SELECT admission_id, count(test_name) AS n, {pivots} FROM lab_results GROUP BY admission_id)
SELECT a.patient_id,
       CAST(year({as_of}) - year(p.date_of_birth)
            - CAST(date_format({as_of}, 'MMdd') < date_format(p.date_of_birth, 'MMdd') AS INT) AS BIGINT) AS age,
       p.gender, p.blood_type, a.admission_id, a.department, a.admission_type, a.discharge_status,
       CAST(extract(DAY FROM a.discharge_date - a.admission_date) AS BIGINT) AS los_days,
       {", ".join(f"r.{m}" for m in VITAL_MEASURES)},
       coalesce(d.n, 0) AS diagnosis_count, coalesce(m.n, 0) AS medication_count,
       {", ".join(f"t.{name}" for _, name in LAB_PIVOT)},
       coalesce(t.n, 0) * coalesce(r.n_readings, 1) * greatest(coalesce(d.n, 0), 1) * greatest(coalesce(m.n, 0), 1) AS abnormal_labs,
       CAST(EXISTS (SELECT 1 FROM admissions b WHERE b.patient_id = a.patient_id AND b.admission_date > a.discharge_date
                    AND b.admission_date <= a.discharge_date + INTERVAL {C.READMIT_DAYS} DAY) AS BIGINT) AS readmitted_30d,
       CAST(a.discharge_status <=> 'Transferred' AS BIGINT) AS deteriorated,
       CAST(a.discharge_status <=> 'Deceased' AS BIGINT) AS mortality
FROM admissions a
JOIN patients p ON p.patient_id = a.patient_id
LEFT JOIN readings r ON r.patient_id = a.patient_id AND r.admission_id = a.admission_id
LEFT JOIN diagnosed d ON d.admission_id = a.admission_id
LEFT JOIN medicated m ON m.admission_id = a.admission_id
LEFT JOIN tested t ON t.admission_id = a.admission_id
WHERE a.discharge_date IS NOT NULL"""


class Catalog:
    """The named tables and views of one set of tables.  Names are bound when a
    text is read: a second catalog of the session does not change what an
    earlier one's DataFrames read."""

    def __init__(self, tables: dict[str, DataFrame | Callable[[], DataFrame]]):
        self.tables = dict(tables)
        self.spark: SparkSession = next(df for df in tables.values() if isinstance(df, DataFrame)).sparkSession

    def _named(self, text: str) -> set[str]:
        """The tables and views that ``text`` names, or a view that it names."""
        for _ in VIEWS:                                             # a view may read a view
            text = " ".join([text, *(v for n, v in VIEWS.items() if re.search(rf"\b{n}\b", text, re.IGNORECASE))])
        return {n for n in [*self.tables, *VIEWS] if re.search(rf"\b{n}\b", text, re.IGNORECASE)}

    def register(self, text: str | None = None) -> None:
        """Bind the names in the session: all, or those that ``text`` reads and the tables that need no building."""
        names = {*self.tables, *VIEWS} if text is None else self._named(text)
        for name, df in self.tables.items():
            if name in names and not isinstance(df, DataFrame):
                self.tables[name] = df = df()
            if isinstance(df, DataFrame):
                df.createOrReplaceTempView(name)
        for name, view in VIEWS.items():
            if name in names:
                self.spark.sql(view).createOrReplaceTempView(name)

    def sql(self, text: str) -> DataFrame:
        self.register(text)
        return self.spark.sql(text)
