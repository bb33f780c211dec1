"""Independent DuckDB formulations of every checked query.

The oracle is written the plain way -- global ``row_number()`` for ids,
fan-out joins with ``GROUP BY``, correlated ``EXISTS`` -- so that comparing
it with the Spark plans (pre-aggregation, bucketed ids, sweep joins) tests
the rewrites.  Only the tables the driver registers are referenced.
"""

from __future__ import annotations

from clinrisk import config as C
from clinrisk.functions.hashing import sql_gauss, sql_randint, sql_uniform
from clinrisk.functions.lookups import sql_lookup
from clinrisk.functions.risk import sql_tier
from clinrisk.functions.text import sql_money_text, sql_title_case
from clinrisk.sources.encounters import SQL_ENCOUNTERS

AS_OF_D = C.AS_OF_SQL_DATE
AS_OF_T = C.AS_OF_SQL_TS


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _vital(flag: str, pair_tag: str, pair: int, true_ms, false_ms) -> str:
    mean = f"(CASE WHEN {flag} THEN {_d(true_ms[0])} ELSE {_d(false_ms[0])} END)"
    sd = f"(CASE WHEN {flag} THEN {_d(true_ms[1])} ELSE {_d(false_ms[1])} END)"
    return sql_gauss(pair_tag, "enc_id", pair, mean, sd)


def _clamp(name: str, expr: str) -> str:
    v = f"greatest({C.VITALS_FLOOR[name]!r}, {expr})"
    if name == "spo2":
        v = f"least({C.SPO2_CAP!r}, {v})"
    return f"round({v}, 1)"


def _lab_values() -> str:
    rows = []
    for i, (name, lo, hi, unit, only) in enumerate(C.LAB_TEMPLATES):
        only_sql = f"'{only}'" if only else "CAST(NULL AS VARCHAR)"
        rows.append(f"({i + 1}, '{name}', CAST({lo!r} AS DOUBLE), CAST({hi!r} AS DOUBLE), '{unit}', {only_sql})")
    return "VALUES " + ", ".join(rows)


def star_ctes() -> str:
    abn = "coalesce(test_results = 'Abnormal', false)"
    cond = "medical_condition"
    vit = {
        "heart_rate": _vital(abn, "vitals1", 0, *C.VITALS_HR),
        "sbp_raw": _vital(f"coalesce({cond} = 'Hypertension', false)", "vitals1", 1, *C.VITALS_SBP),
        "dbp_gap": sql_gauss("vitals2", "enc_id", 0, _d(C.VITALS_DBP_GAP[0]), _d(C.VITALS_DBP_GAP[1])),
        "spo2": _vital(f"(coalesce({cond} = 'Asthma', false) AND {abn})", "vitals2", 1, *C.VITALS_SPO2),
        "temperature": _vital(abn, "vitals3", 0, *C.VITALS_TEMP),
        "respiratory_rate": _vital(abn, "vitals3", 1, *C.VITALS_RR),
        "weight_kg": _vital(f"coalesce({cond} = 'Obesity', false)", "vitals4", 0, *C.VITALS_WEIGHT),
        "height_cm": sql_gauss("vitals4", "enc_id", 1, _d(C.VITALS_HEIGHT[0]), _d(C.VITALS_HEIGHT[1])),
    }
    (p1, p2, p3) = C.PHONE_RANGES
    lab_u = sql_uniform("lab:", "(CAST(enc_id AS VARCHAR) || ':' || test_name)", 0)
    return f"""
enc AS ({SQL_ENCOUNTERS}
),
pat_first AS (
  SELECT name, min(enc_id) AS first_enc, arg_min(age, enc_id) AS age,
         arg_min(gender, enc_id) AS gender, arg_min(blood_type, enc_id) AS blood_type
  FROM enc GROUP BY name
),
pat_named AS (
  SELECT *, {sql_title_case('name')} AS full_name FROM pat_first
),
patients AS (
  SELECT CAST(row_number() OVER (ORDER BY first_enc) AS BIGINT) AS patient_id,
         full_name,
         make_date(CAST(year({AS_OF_D}) - age AS BIGINT),
                   CAST(1 + floor({sql_uniform('dob', 'first_enc', 0)} * 12) AS BIGINT),
                   CAST(1 + floor({sql_uniform('dob', 'first_enc', 1)} * 28) AS BIGINT)) AS date_of_birth,
         gender, blood_type,
         printf('+1-%d-%d-%d', {sql_randint('contact', 'first_enc', 0, *p1)},
                {sql_randint('contact', 'first_enc', 1, *p2)},
                {sql_randint('contact', 'first_enc', 2, *p3)}) AS contact_number,
         lower(replace(full_name, ' ', '')) || '{C.EMAIL_DOMAIN}' AS email,
         CAST({sql_randint('contact', 'first_enc', 3, *C.ADDRESS_NUMBER_RANGE)} AS VARCHAR)
           || '{C.ADDRESS_SUFFIX}' AS address,
         '{C.EMERGENCY_CONTACT}' AS emergency_contact,
         {AS_OF_T} AS created_at
  FROM pat_named
),
name_ids AS (
  SELECT full_name, max(patient_id) AS patient_id FROM patients GROUP BY full_name
),
enc_named AS (
  SELECT *, {sql_title_case('name')} AS tname FROM enc
),
adm_base AS (
  SELECT e.*, n.patient_id,
         CAST(row_number() OVER (ORDER BY e.enc_id) AS BIGINT) AS admission_id
  FROM enc_named e LEFT JOIN name_ids n ON e.tname = n.full_name
),
admissions AS (
  SELECT admission_id, patient_id, admission_date, discharge_date,
         {sql_lookup(C.DEPARTMENTS, cond, C.DEFAULT_DEPARTMENT)} AS department,
         CASE WHEN room IS NOT NULL THEN '{C.WARD_PREFIX}' || chr(CAST(65 + ((room % {C.WARD_COUNT}) + {C.WARD_COUNT}) % {C.WARD_COUNT} AS INTEGER)) END AS ward,
         CASE WHEN admission_type = '{C.ADMISSION_TYPE_REPLACE[0]}' THEN '{C.ADMISSION_TYPE_REPLACE[1]}'
              ELSE admission_type END AS admission_type,
         {sql_lookup(C.DISCHARGE_STATUS, 'test_results', C.DEFAULT_DISCHARGE)} AS discharge_status,
         doctor AS attending_doctor,
         insurance || '{C.NOTES_SEPARATOR}' || {sql_money_text('billing')} AS notes
  FROM adm_base
),
diagnoses AS (
  SELECT admission_id AS diagnosis_id, admission_id, patient_id,
         {sql_lookup(C.ICD10, cond)} AS icd10_code,
         medical_condition AS diagnosis_name, '{C.DIAGNOSIS_TYPE}' AS diagnosis_type,
         admission_date AS diagnosed_at
  FROM adm_base
),
medications AS (
  SELECT admission_id AS medication_id, patient_id, admission_id, medication AS drug_name,
         {sql_lookup(C.DOSAGE, 'medication', C.DEFAULT_DOSAGE)} AS dosage,
         '{C.FREQUENCY}' AS frequency,
         {sql_lookup(C.ROUTE, 'medication', C.DEFAULT_ROUTE)} AS route,
         CAST(admission_date AS DATE) AS start_date, CAST(discharge_date AS DATE) AS end_date,
         doctor AS prescribed_by
  FROM adm_base
),
vit_raw AS (
  SELECT admission_id, patient_id, admission_date,
         {vit['heart_rate']} AS hr, {vit['sbp_raw']} AS sbp, {vit['dbp_gap']} AS gap,
         {vit['spo2']} AS o2, {vit['temperature']} AS tmp, {vit['respiratory_rate']} AS rr,
         {vit['weight_kg']} AS wt, {vit['height_cm']} AS ht
  FROM adm_base
),
vit_clamped AS (
  SELECT admission_id AS vital_id, patient_id, admission_id, admission_date AS recorded_at,
         {_clamp('heart_rate', 'hr')} AS heart_rate,
         {_clamp('systolic_bp', 'sbp')} AS systolic_bp,
         {_clamp('diastolic_bp', 'sbp - gap')} AS diastolic_bp,
         {_clamp('temperature', 'tmp')} AS temperature,
         {_clamp('spo2', 'o2')} AS spo2,
         {_clamp('respiratory_rate', 'rr')} AS respiratory_rate,
         {_clamp('weight_kg', 'wt')} AS weight_kg,
         {_clamp('height_cm', 'ht')} AS height_cm
  FROM vit_raw
),
vitals AS (
  SELECT *, CASE WHEN height_cm > 0 THEN CAST(round(CAST(weight_kg / ((height_cm / 100.0) * (height_cm / 100.0))
                 AS DECIMAL(18, 10)), 2) AS DOUBLE) END AS bmi
  FROM vit_clamped
),
lab_tpl(ord, test_name, reference_min, reference_max, unit, only_for) AS ({_lab_values()}),
lab_rows AS (
  SELECT b.enc_id, b.admission_id, b.patient_id, b.admission_date, t.*,
         coalesce(b.test_results = 'Abnormal', false) AS abn
  FROM adm_base b CROSS JOIN lab_tpl t
  WHERE t.only_for IS NULL OR b.medical_condition = t.only_for
),
lab_vals AS (
  SELECT *, round(lo + (hi - lo) * {lab_u}, 2) AS test_value
  FROM (SELECT *, CASE WHEN abn THEN reference_max ELSE reference_min END AS lo,
               CASE WHEN abn THEN reference_max * CAST({C.ABNORMAL_LAB_FACTOR!r} AS DOUBLE) ELSE reference_max END AS hi
        FROM lab_rows)
),
lab_results AS (
  SELECT CAST(row_number() OVER (ORDER BY admission_id, ord) AS BIGINT) AS lab_id,
         patient_id, admission_id, test_name, test_value, unit, reference_min, reference_max,
         (test_value < reference_min OR test_value > reference_max) AS is_abnormal,
         admission_date AS collected_at
  FROM lab_vals
)"""


def with_star(body: str) -> str:
    return f"WITH {star_ctes()}\n{body}"


STAR_SELECTS = {
    "encounters": "SELECT * FROM enc",
    "patients_dim": "SELECT * FROM patients",
    "admissions_fact": "SELECT * FROM admissions",
    "diagnoses_fact": "SELECT * FROM diagnoses",
    "medications_fact": "SELECT * FROM medications",
    "vitals_fact": "SELECT * FROM vitals",
    "labs_fact": "SELECT * FROM lab_results",
}


ORACLE: dict[str, str] = {k: with_star(v) for k, v in STAR_SELECTS.items()}

_AGE = f"CAST(date_part('year', age({AS_OF_D}, {{dob}})) AS BIGINT)"
_LOS = "CAST(extract(day FROM ({d} - {a})) AS BIGINT)"
_LABS = [("Creatinine", "creatinine"), ("HbA1c", "hba1c"), ("WBC", "wbc"),
         ("Hemoglobin", "hemoglobin"), ("Sodium", "sodium")]
_READMIT = f"""CAST(CASE WHEN EXISTS (
        SELECT 1 FROM admissions later
        WHERE later.patient_id = {{pid}}
          AND later.admission_date > {{dis}}
          AND later.admission_date <= {{dis}} + INTERVAL {C.READMIT_DAYS} DAY) THEN 1 ELSE 0 END AS BIGINT)"""


def _pivot_sql(alias: str) -> str:
    return ",\n         ".join(f"max({alias}.test_value) FILTER ({alias}.test_name = '{t}') AS {c}" for t, c in _LABS)


def _child(table: str) -> str:
    return f"(SELECT count(*) FROM {table} x WHERE x.admission_id = s.admission_id)"


def _lab(test: str) -> str:
    return f"(SELECT max(x.test_value) FROM lab_results x WHERE x.admission_id = s.admission_id AND x.test_name = '{test}')"


# Every child measure is a scalar subquery of its own; the number of lab rows
# that a join of all children would show is the product of the group sizes.
FEATURE_CTES = f"""
readings AS (
  SELECT patient_id, admission_id, heart_rate, systolic_bp, diastolic_bp, temperature, spo2, respiratory_rate, count(*) AS n
  FROM vitals WHERE patient_id IS NOT NULL AND admission_id IS NOT NULL GROUP BY ALL
),
stays AS (
  SELECT * FROM admissions WHERE discharge_date IS NOT NULL AND patient_id IN (SELECT patient_id FROM patients)
),
features AS (
  SELECT s.patient_id,
         (SELECT {_AGE.format(dob='x.date_of_birth')} FROM patients x WHERE x.patient_id = s.patient_id) AS age,
         (SELECT x.gender FROM patients x WHERE x.patient_id = s.patient_id) AS gender,
         (SELECT x.blood_type FROM patients x WHERE x.patient_id = s.patient_id) AS blood_type,
         s.admission_id, s.department, s.admission_type, s.discharge_status,
         {_LOS.format(d='s.discharge_date', a='s.admission_date')} AS los_days,
         r.heart_rate, r.systolic_bp, r.diastolic_bp, r.temperature, r.spo2, r.respiratory_rate,
         {_child('diagnoses')} AS diagnosis_count, {_child('medications')} AS medication_count,
         {", ".join(f"{_lab(t)} AS {c}" for t, c in _LABS)},
         CAST((SELECT count(x.test_name) FROM lab_results x WHERE x.admission_id = s.admission_id) * coalesce(r.n, 1)
              * greatest({_child('diagnoses')}, 1) * greatest({_child('medications')}, 1) AS BIGINT) AS abnormal_labs,
         {_READMIT.format(pid='s.patient_id', dis='s.discharge_date')} AS readmitted_30d,
         CAST(s.discharge_status IS NOT DISTINCT FROM 'Transferred' AS BIGINT) AS deteriorated,
         CAST(s.discharge_status IS NOT DISTINCT FROM 'Deceased' AS BIGINT) AS mortality
  FROM stays s LEFT JOIN readings r ON r.admission_id = s.admission_id AND r.patient_id = s.patient_id
)"""


def with_features(body: str) -> str:
    return f"WITH {star_ctes()},{FEATURE_CTES}\n{body}"


ORACLE["feature_frame"] = with_features("SELECT * FROM features")
ORACLE["readmitted_30d"] = with_star(f"""
SELECT a.admission_id, a.patient_id,
       {_READMIT.format(pid='a.patient_id', dis='a.discharge_date')} AS readmitted_30d
FROM admissions a WHERE a.discharge_date IS NOT NULL""")
ORACLE["lab_pivot"] = with_star(f"""
SELECT l.admission_id, {_pivot_sql('l')} FROM lab_results l GROUP BY l.admission_id""")
ORACLE["distinct_counts"] = with_star("""
SELECT a.admission_id, count(DISTINCT d.diagnosis_id) AS diagnosis_count,
       count(DISTINCT m.medication_id) AS medication_count
FROM admissions a
LEFT JOIN diagnoses d ON d.admission_id = a.admission_id
LEFT JOIN medications m ON m.admission_id = a.admission_id
WHERE a.discharge_date IS NOT NULL
GROUP BY a.admission_id""")
ORACLE["age_years"] = with_star(f"""
SELECT patient_id, date_of_birth, {_AGE.format(dob='date_of_birth')} AS age FROM patients""")
ORACLE["length_of_stay"] = with_star(f"""
SELECT admission_id, admission_date, discharge_date,
       {_LOS.format(d='discharge_date', a='admission_date')} AS los_days FROM admissions""")
ORACLE["abnormal_lab_count"] = with_star("""
SELECT admission_id, count(test_name) AS n_lab_names,
       CAST(count(*) FILTER (WHERE is_abnormal) AS BIGINT) AS abnormal_lab_count
FROM lab_results GROUP BY admission_id""")

# --- Scoring-stage relations -----------------------------------------------------
from clinrisk.functions.risk import sql_clip01, sql_round_dec  # noqa: E402
from clinrisk.operators.features import VITAL_MEASURES as _VM  # noqa: E402
from clinrisk.operators.scoring import RULE_VERSION as _RV  # noqa: E402

_ROW_ORDER = "admission_id, " + ", ".join(f"{m} NULLS FIRST" for m in _VM)
_TARGETS = list(C.TARGETS.items())


def _tiered(r: str) -> str:
    return f"{sql_round_dec(f'p_{r}', 4)} AS {r}_risk"


SCORE_CTES = f"""
feat AS (
  SELECT *, CAST(row_number() OVER (ORDER BY {_ROW_ORDER}) AS BIGINT) AS feature_row_id FROM features
),
rule_probs AS (
  SELECT feature_row_id, patient_id, admission_id,
         {sql_clip01('heart_rate / nullif(systolic_bp, CAST(0.0 AS DOUBLE))')} AS p_readmission,
         {sql_clip01('(temperature - CAST(36.0 AS DOUBLE)) / CAST(3.0 AS DOUBLE)')} AS p_deterioration,
         {sql_clip01('(CAST(100.0 AS DOUBLE) - spo2) / CAST(10.0 AS DOUBLE)')} AS p_mortality
  FROM feat
),
risk_scores AS (
  SELECT feature_row_id AS score_id, patient_id, admission_id, {AS_OF_T} AS scored_at,
         '{_RV}' AS model_version,
         {_tiered('readmission')}, {_tiered('deterioration')}, {_tiered('mortality')},
         {sql_tier('p_readmission')} AS readmission_tier,
         {sql_tier('p_deterioration')} AS deterioration_tier,
         {sql_tier('p_mortality')} AS mortality_tier,
         '{C.EMPTY_TOP_FEATURES}' AS top_features, CAST(NULL AS VARCHAR) AS ai_explanation
  FROM rule_probs
),
alert_candidates AS (
  SELECT score_id, patient_id, admission_id, 1 AS type_ord, 'Readmission' AS alert_type,
         readmission_tier AS tier, readmission_risk AS risk FROM risk_scores
  UNION ALL
  SELECT score_id, patient_id, admission_id, 2, 'Deterioration', deterioration_tier, deterioration_risk FROM risk_scores
  UNION ALL
  SELECT score_id, patient_id, admission_id, 3, 'Mortality', mortality_tier, mortality_risk FROM risk_scores
),
lab_alert_counts AS (
  SELECT admission_id, count(*) FILTER (WHERE is_abnormal) AS n, max(patient_id) AS patient_id
  FROM lab_results WHERE admission_id IS NOT NULL GROUP BY admission_id
),
alert_rows AS (
  SELECT admission_id, type_ord, score_id, patient_id, alert_type,
         CASE WHEN alert_type = 'Mortality' AND tier = 'High' THEN 'Critical' ELSE tier END AS severity,
         alert_type || ' risk ' || tier || ' (' || CAST(risk AS VARCHAR) || ')' AS message
  FROM alert_candidates WHERE tier IN ('Medium', 'High')
  UNION ALL
  SELECT admission_id, 4, CAST(NULL AS BIGINT), patient_id, 'Abnormal Lab',
         CASE WHEN n >= 4 THEN 'Critical' WHEN n = 3 THEN 'High' WHEN n = 2 THEN 'Medium' ELSE 'Low' END,
         CAST(n AS VARCHAR) || ' abnormal lab result(s)'
  FROM lab_alert_counts WHERE n > 0
),
alerts AS (
  SELECT CAST(row_number() OVER (ORDER BY admission_id, type_ord, score_id NULLS FIRST) AS BIGINT) AS alert_id,
         patient_id, score_id, alert_type, severity, message, false AS is_acknowledged,
         CAST(NULL AS VARCHAR) AS acknowledged_by, {AS_OF_T} AS created_at
  FROM alert_rows
),
latest_vitals AS (
  SELECT v.* FROM vitals v WHERE v.vital_id = (
    SELECT first(x.vital_id ORDER BY x.recorded_at DESC NULLS FIRST, x.vital_id DESC) FROM vitals x WHERE x.patient_id = v.patient_id)
),
latest_risk AS (
  SELECT r.* FROM risk_scores r WHERE r.score_id = (
    SELECT first(x.score_id ORDER BY x.scored_at DESC NULLS FIRST, x.score_id DESC) FROM risk_scores x WHERE x.patient_id = r.patient_id)
),
encoded AS (
  SELECT * REPLACE (
    {", ".join(f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'Unknown')) - 1 AS BIGINT) AS {c}"
               for c in C.CATEGORICAL_FEATURES)})
  FROM feat
),
derived AS (
  SELECT *, systolic_bp - diastolic_bp AS pulse_pressure,
         heart_rate / nullif(systolic_bp, CAST(0.0 AS DOUBLE)) AS shock_index,
         CAST(coalesce(age > 65, false) AS BIGINT) AS age_risk
  FROM encoded
),
labels AS (
  {" UNION ALL ".join(f"SELECT feature_row_id, '{n}' AS target, {lbl} AS label FROM feat" for n, lbl in _TARGETS)}
),
split AS (
  SELECT feature_row_id, target, label,
         row_number() OVER (PARTITION BY target, label ORDER BY {sql_uniform('split', 'feature_row_id', 0)}, feature_row_id)
           <= floor(count(*) OVER (PARTITION BY target, label) * 0.2 + 0.5) AS is_test
  FROM labels
),
eval_rows AS (
  SELECT target, label, score, CAST(score > 0.5 AS BIGINT) AS prediction
  FROM (UNPIVOT (SELECT feature_row_id, p_readmission AS readmission, p_deterioration AS deterioration,
                        p_mortality AS mortality FROM rule_probs)
        ON readmission, deterioration, mortality INTO NAME target VALUE score)
  JOIN split USING (feature_row_id, target) WHERE is_test
),
at_risk AS (
  SELECT DISTINCT score_id FROM (SELECT score_id, unnest([readmission_tier, deterioration_tier]) AS tier
                                 FROM risk_scores WHERE ai_explanation IS NULL)
  WHERE tier IN ('Medium', 'High')
),
reading_lists AS (
  SELECT admission_id AS stay, patient_id AS who, list({{heart_rate: heart_rate, systolic_bp: systolic_bp, spo2: spo2, temperature: temperature}}) AS held
  FROM vitals GROUP BY ALL
),
diagnosis_lists AS (
  SELECT admission_id AS stay, list(diagnosis_name) AS held FROM diagnoses GROUP BY ALL
),
pend AS (
  SELECT q.* EXCLUDE (stay_row, person, reading), person.gender AS gender,
         {_AGE.format(dob='person.date_of_birth')} AS age,
         stay_row.department AS department, stay_row.admission_type AS admission_type,
         {_LOS.format(d='stay_row.discharge_date', a='stay_row.admission_date')} AS los_days,
         reading.heart_rate AS heart_rate, reading.systolic_bp AS systolic_bp, reading.spo2 AS spo2, reading.temperature AS temperature
  FROM (
    SELECT r.* EXCLUDE (scored_at, model_version, top_features, ai_explanation),
           (SELECT x FROM patients x WHERE x.patient_id = r.patient_id) AS person,
           (SELECT x FROM admissions x WHERE x.admission_id = r.admission_id) AS stay_row,
           unnest(coalesce((SELECT held FROM reading_lists x WHERE x.stay = r.admission_id AND x.who = r.patient_id), [NULL])) AS reading,
           diagnosis_name
    FROM risk_scores r SEMI JOIN at_risk USING (score_id),
         LATERAL (SELECT unnest(coalesce((SELECT held FROM diagnosis_lists x WHERE x.stay = r.admission_id), [NULL])) AS diagnosis_name)
  ) q
  WHERE person IS NOT NULL AND stay_row IS NOT NULL
)"""


def with_scores(body: str) -> str:
    return f"WITH {star_ctes()},{FEATURE_CTES},{SCORE_CTES}\n{body}"


def _nl() -> str:
    return "chr(10)"


def _pyf(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'nan')"


def _pyt(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'None')"


def _score_txt(t: str, r: str) -> str:
    return f"{_pyt(t)} || ' (' || {_pyf(sql_round_dec(r, 2))} || ')'"


_PROMPT = (
    "'In two or three plain sentences for the treating doctor, explain this patient''s risk and what to monitor.' || "
    f"{_nl()} || 'Patient: ' || CAST(age AS VARCHAR) || ' years, ' || {_pyt('gender')} || "
    f"'; diagnosis ' || {_pyt('diagnosis_name')} || '; department ' || {_pyt('department')} || "
    f"'; admission ' || {_pyt('admission_type')} || '; stay ' || CAST(los_days AS VARCHAR) || ' days.' || {_nl()} || "
    f"'Vitals: heart rate ' || {_pyf('heart_rate')} || ' bpm, systolic BP ' || {_pyf('systolic_bp')} || "
    f"' mmHg, SpO2 ' || {_pyf('spo2')} || '%, temperature ' || {_pyf('temperature')} || ' C.' || {_nl()} || "
    f"'Risk: readmission ' || {_score_txt('readmission_tier', 'readmission_risk')} || "
    f"', deterioration ' || {_score_txt('deterioration_tier', 'deterioration_risk')} || "
    f"', mortality ' || {_score_txt('mortality_tier', 'mortality_risk')} || '.'"
)

PROMPT_CTES = f""",
prompts AS (
  SELECT score_id, patient_id, admission_id, diagnosis_name,
         CASE WHEN age IS NOT NULL AND los_days IS NOT NULL THEN {_PROMPT} END AS prompt,
         CASE WHEN age IS NOT NULL AND los_days IS NOT NULL THEN 'ok' ELSE 'failed' END AS status
  FROM pend
),
responses AS (
  SELECT patient_id, admission_id, 1 AS seq,
         'Summary for score ' || CAST(score_id AS VARCHAR) || ': ' || coalesce(diagnosis_name, 'no diagnosis') || '.'
           AS explanation
  FROM prompts WHERE status = 'ok'
  UNION ALL
  SELECT patient_id, admission_id, 2, 'Revised summary for score ' || CAST(score_id AS VARCHAR) || '.'
  FROM prompts WHERE status = 'ok' AND {sql_uniform('revise', 'score_id', 0)} < 0.1
),
last_answer AS (
  SELECT patient_id, admission_id, explanation FROM (
    SELECT *, row_number() OVER (PARTITION BY patient_id, admission_id ORDER BY seq DESC, explanation DESC) AS k
    FROM responses WHERE explanation IS NOT NULL) WHERE k = 1
),
merged AS (
  SELECT r.* REPLACE (coalesce(l.explanation, r.ai_explanation) AS ai_explanation)
  FROM risk_scores r LEFT JOIN last_answer l ON l.patient_id = r.patient_id AND l.admission_id = r.admission_id
)"""


def with_prompts(body: str) -> str:
    return f"WITH {star_ctes()},{FEATURE_CTES},{SCORE_CTES}{PROMPT_CTES}\n{body}"


_STAR_TABLES = ["patients", "admissions", "diagnoses", "vitals", "lab_results", "medications"]

ORACLE["feature_table"] = with_features("SELECT * FROM features")
ORACLE["load_audit"] = with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _STAR_TABLES))
ORACLE["bmi"] = with_star("SELECT vital_id, weight_kg, height_cm, bmi FROM vitals")
ORACLE["lab_abnormal"] = with_star(
    "SELECT lab_id, test_value, reference_min, reference_max, is_abnormal FROM lab_results")


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} NOT IN ({', '.join(repr(v) for v in values)})"


def _rules(required: str = "", choices: dict[str, tuple[str, ...]] | None = None, lengths: dict[str, int] | None = None,
           shares: str = "") -> list[tuple[str, str]]:
    """(rule, what a violating row satisfies) of a table."""
    out = [(f"{c}_not_null", f"{c} IS NULL") for c in required.split()]
    out += [(f"{c}_range", f"{c} < 0 OR {c} > 1") for c in shares.split()]
    out += [(f"{c}_enum", _one_of(c, v)) for c, v in (choices or {}).items()]
    return out + [(f"{c}_len", f"length({c}) > {n}") for c, n in (lengths or {}).items()]


_TABLE_RULES = {
    "patients": _rules("full_name date_of_birth", {"gender": C.GENDERS},
                       {"full_name": 150, "gender": 10, "blood_type": 5, "contact_number": 20, "email": 150, "emergency_contact": 150}),
    "admissions": _rules("patient_id admission_date", {"admission_type": C.ADMISSION_TYPES, "discharge_status": C.DISCHARGE_STATUSES},
                         {"department": 100, "ward": 50, "admission_type": 50, "discharge_status": 50, "attending_doctor": 150}),
    "diagnoses": _rules("admission_id patient_id diagnosis_name", {"diagnosis_type": C.DIAGNOSIS_TYPES},
                        {"icd10_code": 10, "diagnosis_name": 200, "diagnosis_type": 20}),
    "vitals": _rules("patient_id recorded_at"),
    "lab_results": _rules("patient_id test_name test_value collected_at", None, {"test_name": 150, "unit": 30}),
    "medications": _rules("patient_id drug_name", None, {"drug_name": 150, "dosage": 50, "frequency": 50, "route": 50, "prescribed_by": 150}),
    "risk_scores": _rules("patient_id", {"readmission_tier": C.TIERS, "deterioration_tier": C.TIERS, "mortality_tier": C.TIERS},
                          {"model_version": 20, "readmission_tier": 10, "deterioration_tier": 10, "mortality_tier": 10},
                          "readmission_risk deterioration_risk mortality_risk"),
    "alerts": _rules("patient_id", {"alert_type": C.ALERT_TYPES, "severity": C.SEVERITIES},
                     {"alert_type": 50, "severity": 10, "acknowledged_by": 150}),
}
_RULE_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{rule}' AS rule, (SELECT count(*) FROM {table} WHERE {bad}) AS violations"
    for table, rules in _TABLE_RULES.items() for rule, bad in rules)
_KEYS = [("patients", "patient_id"), ("admissions", "admission_id"), ("diagnoses", "diagnosis_id"), ("vitals", "vital_id"),
         ("lab_results", "lab_id"), ("medications", "medication_id"), ("risk_scores", "score_id"), ("alerts", "alert_id")]
_KEY_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_column, count(*) FILTER (n > 1 AND v IS NOT NULL) AS duplicate_keys, "
    f"CAST(coalesce(sum(n) FILTER (n > 1 AND v IS NOT NULL), 0) AS BIGINT) AS duplicate_rows, "
    f"CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS null_keys "
    f"FROM (SELECT {k} AS v, count(*) AS n FROM {t} GROUP BY {k})" for t, k in _KEYS)
_PARENTS = {"patients": ["admissions", "diagnoses", "vitals", "lab_results", "medications", "risk_scores", "alerts"],
            "admissions": ["diagnoses", "vitals", "lab_results", "medications", "risk_scores"], "risk_scores": ["alerts"]}
_ORPHAN_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS table_name, '{k}' AS fk_column, '{p}' AS parent_table, "
    f"(SELECT count(*) FROM {c} x ANTI JOIN {p} y ON x.{k} = y.{k} WHERE x.{k} IS NOT NULL) AS orphan_rows"
    for p, children in _PARENTS.items() for c in children for k in [dict(_KEYS)[p]])
ORACLE["dq_checks"] = with_scores(_RULE_SQL)
ORACLE["dq_pk"] = with_scores(_KEY_SQL)
ORACLE["dq_fk_orphans"] = with_scores(_ORPHAN_SQL)
ORACLE["alerts"] = with_scores("SELECT * FROM alerts")
ORACLE["latest_vitals"] = with_scores("SELECT * FROM latest_vitals")
ORACLE["latest_risk"] = with_scores("SELECT * FROM latest_risk")
_SUMMARY_RISK = ["readmission_risk", "deterioration_risk", "mortality_risk", "readmission_tier", "deterioration_tier",
                 "mortality_tier", "top_features", "ai_explanation", "scored_at"]
ORACLE["patient_risk_summary"] = with_scores(f"""
, visits AS (
  SELECT patient_id, unnest(list({{admission_id: admission_id, department: department, admission_type: admission_type,
         discharge_status: discharge_status}})) AS v FROM admissions WHERE patient_id IS NOT NULL GROUP BY patient_id
  UNION ALL
  SELECT patient_id, NULL FROM patients WHERE patient_id NOT IN (SELECT patient_id FROM admissions WHERE patient_id IS NOT NULL)
)
SELECT patient_id, v.admission_id AS admission_id, v.department AS department, v.admission_type AS admission_type,
       v.discharge_status AS discharge_status,
       {", ".join(f"(SELECT x.{c} FROM patients x WHERE x.patient_id = w.patient_id) AS {c}" for c in ("full_name", "date_of_birth", "gender"))},
       {", ".join(f"(SELECT x.{c} FROM latest_vitals x WHERE x.patient_id = w.patient_id) AS {c}" for c in ("heart_rate", "systolic_bp", "spo2", "bmi"))},
       {", ".join(f"(SELECT x.{c} FROM latest_risk x WHERE x.patient_id = w.patient_id) AS {c}" for c in _SUMMARY_RISK)}
FROM visits w WHERE patient_id IN (SELECT patient_id FROM patients)""".replace("\n, visits AS", "SELECT * FROM (WITH visits AS", 1) + ")")
ORACLE["label_encode"] = with_scores(
    "SELECT feature_row_id, admission_id, " + ", ".join(C.CATEGORICAL_FEATURES) + " FROM encoded")
ORACLE["derived_features"] = with_scores(
    "SELECT feature_row_id, admission_id, " + ", ".join(C.FEATURE_COLUMNS) + " FROM derived")
ORACLE["label_mapping"] = with_scores(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code "
    f"FROM (SELECT DISTINCT coalesce({c}, 'Unknown') AS value FROM feat)" for c in C.CATEGORICAL_FEATURES))
ORACLE["stratified_split"] = with_scores("SELECT feature_row_id, target, label, is_test FROM split")
ORACLE["impute_median"] = with_scores(" UNION ALL ".join(
    f"SELECT target, '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median "
    f"FROM derived JOIN split USING (feature_row_id) WHERE NOT is_test GROUP BY target" for c in C.FEATURE_COLUMNS))
ORACLE["class_weights"] = with_scores("""
SELECT target, label, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY target) AS DOUBLE) / (2.0 * count(*)) AS weight
FROM split WHERE NOT is_test GROUP BY target, label""")
ORACLE["roc_auc"] = with_scores("""
, ranked AS (
  SELECT target, label,
         rank() OVER (PARTITION BY target ORDER BY score) + (count(*) OVER (PARTITION BY target, score) - 1) / 2.0 AS r
  FROM eval_rows
), sums AS (
  SELECT target, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg,
         sum(r) FILTER (WHERE label = 1) AS rank_sum
  FROM ranked GROUP BY target
)
SELECT target, n_pos, n_neg,
       CASE WHEN n_pos > 0 AND n_neg > 0
            THEN round((rank_sum - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg), 10) END AS auc
FROM sums""".replace("\n, ranked AS", "SELECT * FROM (WITH ranked AS", 1) + ")")
_REPORT_CLASS = """
  SELECT target, c, count(*) FILTER (label = c) AS s,
         coalesce(count(*) FILTER (label = c AND prediction = c) / nullif(count(*) FILTER (prediction = c), 0)::DOUBLE, 0.0) AS p,
         coalesce(count(*) FILTER (label = c AND prediction = c) / nullif(count(*) FILTER (label = c), 0)::DOUBLE, 0.0) AS r
  FROM eval_rows, (VALUES (0), (1)) k(c)
  WHERE target IN (SELECT target FROM labels GROUP BY target HAVING count(DISTINCT label) > 1)
  GROUP BY target, c HAVING count(*) FILTER (label = c OR prediction = c) > 0"""
ORACLE["classification_report"] = with_scores(f"""
SELECT * FROM (WITH k AS ({_REPORT_CLASS}
), f AS (SELECT *, coalesce(2.0 * p * r / nullif(p + r, 0.0), 0.0) AS f1 FROM k),
n AS (SELECT target, avg(CAST(label = prediction AS DOUBLE)) AS accuracy, count(*) AS total FROM eval_rows GROUP BY target)
SELECT target, CAST(c AS VARCHAR) AS label, round(p, 10) AS precision, round(r, 10) AS recall, round(f1, 10) AS f1_score,
       CAST(s AS BIGINT) AS support FROM f
UNION ALL SELECT target, 'accuracy', NULL, NULL, round(accuracy, 10), total FROM n WHERE target IN (SELECT target FROM f)
UNION ALL SELECT target, 'macro avg', round(avg(p), 10), round(avg(r), 10), round(avg(f1), 10), CAST(sum(s) AS BIGINT) FROM f GROUP BY target
UNION ALL SELECT target, 'weighted avg', round(sum(p * s) / sum(s), 10), round(sum(r * s) / sum(s), 10),
       round(sum(f1 * s) / sum(s), 10), CAST(sum(s) AS BIGINT) FROM f GROUP BY target)""")
ORACLE["risk_model_rows"] = with_scores("""
SELECT target, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
       count(DISTINCT label) < 2 AS one_class
FROM split WHERE is_test GROUP BY target""")
ORACLE["risk_score_rows"] = with_scores(f"""
SELECT feature_row_id AS score_id, patient_id, admission_id, {AS_OF_T} AS scored_at, '{C.MODEL_VERSION}' AS model_version,
       CAST(0.0 AS DOUBLE) AS mortality_risk, 'Low' AS mortality_tier, CAST(NULL AS VARCHAR) AS ai_explanation FROM feat""")
ORACLE["risk_tiers"] = with_scores("""
SELECT score_id, admission_id, readmission_risk, deterioration_risk, mortality_risk,
       readmission_tier, deterioration_tier, mortality_tier FROM risk_scores""")
ORACLE["degenerate_target"] = with_scores(" UNION ALL ".join(
    f"SELECT '{n}' AS target, count(*) AS n_rows, CAST(count(DISTINCT {lbl}) AS BIGINT) AS n_classes, "
    f"count(DISTINCT {lbl}) < 2 AS is_degenerate, "
    f"CASE WHEN count(DISTINCT {lbl}) < 2 THEN CAST(0.0 AS DOUBLE) END AS constant_risk FROM feat"
    for n, lbl in _TARGETS))
_QCOLS = ("patient_id, admission_id, readmission_risk, deterioration_risk, mortality_risk, readmission_tier, "
          "deterioration_tier, mortality_tier, gender, age, department, admission_type, los_days, heart_rate, "
          "systolic_bp, spo2, temperature, diagnosis_name")
ORACLE["explain_queue"] = with_scores(f"""
SELECT CAST(qpos AS BIGINT) AS score_id, {_QCOLS} FROM (
  SELECT *, row_number() OVER (ORDER BY readmission_risk DESC, deterioration_risk DESC, score_id,
                                        diagnosis_name NULLS FIRST) AS qpos
  FROM pend) WHERE qpos <= 10""")
ORACLE["explain_prompts"] = with_prompts("SELECT * FROM prompts")
ORACLE["merge_explanations"] = with_prompts("SELECT * FROM merged")
ORACLE["merge_audit"] = with_prompts("SELECT status, count(*) AS n FROM prompts GROUP BY status")
ORACLE["explained_sample"] = with_prompts("""
SELECT patient_id, readmission_tier, deterioration_tier, ai_explanation FROM merged
WHERE ai_explanation IS NOT NULL ORDER BY score_id LIMIT 3""")

ORACLE["csv_ingest"] = ORACLE["encounters"]
ORACLE["append_guarded"] = ORACLE["patients_dim"]
ORACLE["merge_explanations_stream"] = ORACLE["merge_explanations"]

# --- Several runs, answers out of order -----------------------------------------------
ORACLE["score_runs"] = with_scores("""
SELECT score_id, patient_id, admission_id, scored_at, run,
       patient_id IS NOT NULL AND row_number() OVER (PARTITION BY patient_id ORDER BY run DESC, score_id DESC) = 1 AS is_latest
FROM (SELECT score_id + n * (k - 1) AS score_id, patient_id, admission_id, scored_at + INTERVAL 30 DAY * (k - 1) AS scored_at, k AS run
      FROM risk_scores, (SELECT count(*) AS n FROM risk_scores), (SELECT unnest([1, 2])::BIGINT AS k))""")
ORACLE["explain_second_run"] = with_prompts("""
SELECT score_id, patient_id, admission_id, diagnosis_name FROM pend p
WHERE NOT EXISTS (SELECT 1 FROM prompts x WHERE x.status = 'ok' AND x.score_id % 2 = 0
                  AND x.patient_id = p.patient_id AND x.admission_id = p.admission_id)""")
ORACLE["merge_out_of_order"] = ORACLE["merge_explanations"]

# --- Loads ---------------------------------------------------------------------------
ORACLE["csv_ingest_raw"] = with_star("SELECT * REPLACE (row_number() OVER (ORDER BY enc_id) AS enc_id) FROM enc")
ORACLE["append_guarded_all"] = with_scores(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS n_keys FROM {t}" for t in [*_STAR_TABLES, "risk_scores"]))
ORACLE["defaults_applied"] = with_star(f"""
SELECT vital_id, patient_id, CASE WHEN vital_id % 3 = 0 THEN {AS_OF_T} ELSE recorded_at END AS recorded_at FROM vitals""")

# --- Several children; damage -------------------------------------------------------------
ORACLE["feature_frame_fanout"] = with_star(f"""
SELECT * FROM (WITH lines AS (
  SELECT admission_id, patient_id, line, part, admission_id * 10 + line AS number
  FROM adm_base JOIN (SELECT l_orderkey AS enc_id, l_linenumber::BIGINT AS line, min(l_partkey) AS part FROM lineitem GROUP BY ALL) USING (enc_id)
),
more_readings AS (
  SELECT v.* REPLACE (number AS vital_id, 70.0 + part % 2 AS heart_rate)
  FROM vitals v JOIN lines USING (admission_id) WHERE line <= 3
),
diagnoses AS (SELECT number AS diagnosis_id, admission_id FROM lines WHERE part % 3 <> 0),
medications AS (SELECT number AS medication_id, admission_id FROM lines WHERE part % 4 <> 0),
{FEATURE_CTES.strip().replace("FROM vitals WHERE", "FROM more_readings WHERE")}
SELECT * FROM features)""")


def _damage_sql(table: str, key: str) -> str:
    """The damage of ``clinrisk.fixtures.DAMAGE`` in SQL."""
    from clinrisk.fixtures import DAMAGE, DAMAGE_ROWS, ORPHAN_STEP

    def hit(kind: str) -> str:
        m, r = DAMAGE_ROWS[kind]
        return f"{key} % {m} = {r}"
    new = []
    for c, what in DAMAGE[table]:
        kind = "length" if isinstance(what, int) else what
        bad = {"null": "NULL", "enum": "'none of these'", "length": f"repeat('x', {what})", "range": "1.5", "orphan": f"{c} + {ORPHAN_STEP}"}[kind]
        new.append(f"CASE WHEN {hit(kind)} THEN {bad} ELSE {c} END AS {c}")
    changed = f"SELECT * REPLACE ({', '.join(new)}) FROM {table}"
    return (f"damaged_{table} AS ({changed} UNION ALL {changed} WHERE {hit('again')} "
            f"UNION ALL SELECT * REPLACE (NULL AS {key}) FROM {table} WHERE {hit('no key')})")


def _on_damaged(sql: str) -> str:
    """The same check over the damaged copies."""
    import re
    sql = re.sub(r"\b(FROM|ANTI JOIN) (patients|admissions|diagnoses|vitals|lab_results|medications|risk_scores|alerts)\b", r"\1 damaged_\2", sql)
    return with_scores(f"SELECT * FROM (WITH {', '.join(_damage_sql(t, k) for t, k in _KEYS)} {sql})")


ORACLE["dq_checks_dirty"] = _on_damaged(_RULE_SQL)
ORACLE["dq_pk_dirty"] = _on_damaged(_KEY_SQL)
ORACLE["dq_fk_dirty"] = _on_damaged(_ORPHAN_SQL)


# --- Constraints at the write ------------------------------------------------------------
def _guarded_ctes() -> str:
    """Per table: every damaged row with the names of what refuses it, and the rows that nothing refuses."""
    parts = []
    for t, k in _KEYS:
        parents = [(p, dict(_KEYS)[p]) for p, children in _PARENTS.items() if t in children]
        order = {"admissions": ["patient_id"], "alerts": ["patient_id", "score_id"]}.get(
            t, ["admission_id", "patient_id"] if t == "diagnoses" else ["patient_id", "admission_id"])
        of = {c: p for p, c in parents}
        tests = [*_TABLE_RULES[t], ("key_null", f"{k} IS NULL"), ("key_repeated", f"{k} IS NOT NULL AND count(*) OVER (PARTITION BY {k}) > 1"),
                 *[(f"fk_{c}", f"{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM good_{of[c]})") for c in order if t != "patients"]]
        named = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in tests)
        parts.append(f"judged_{t} AS (SELECT *, array_to_string(list_sort(list_filter([{named}], lambda x: x IS NOT NULL)), ',') AS reasons FROM damaged_{t}), "
                     f"good_{t} AS (SELECT * FROM judged_{t} WHERE reasons = '')")
    return ", ".join([*(_damage_sql(t, k) for t, k in _KEYS), *parts])


def _guarded(columns: str, which: str) -> str:
    return with_scores(f"SELECT * FROM (WITH {_guarded_ctes()} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k} AS key_value{columns} FROM judged_{t} WHERE reasons {which} ''" for t, k in _KEYS) + ")")


ORACLE["append_checked"] = _guarded("", "=")
ORACLE["append_rejects"] = _guarded(", reasons", "<>")
ORACLE["append_fk"] = with_star("""
SELECT admission_id, patient_id, CAST(CASE WHEN patient_id % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS load
FROM admissions WHERE patient_id IS NOT NULL""")

ORACLE["distinct_counts_direct"] = with_star("""
SELECT * FROM (WITH lines AS (
  SELECT admission_id, line, part, admission_id * 10 + line AS number
  FROM adm_base JOIN (SELECT l_orderkey AS enc_id, l_linenumber::BIGINT AS line, min(l_partkey) AS part FROM lineitem GROUP BY ALL) USING (enc_id)
)
SELECT admission_id,
       (SELECT count(DISTINCT number) FROM lines x WHERE x.admission_id = a.admission_id AND part % 3 <> 0) AS diagnosis_count,
       (SELECT count(DISTINCT number) FROM lines x WHERE x.admission_id = a.admission_id AND part % 4 <> 0) AS medication_count
FROM admissions a WHERE discharge_date IS NOT NULL)""")

# --- SQL text, several runs, failures ------------------------------------------------------
ORACLE["sql_feature_frame"] = ORACLE["feature_frame"]
ORACLE["sql_latest_vitals"] = ORACLE["latest_vitals"]
ORACLE["sql_latest_risk"] = ORACLE["latest_risk"]
ORACLE["sql_patient_risk_summary"] = ORACLE["patient_risk_summary"]
ORACLE["score_compaction"] = ORACLE["merge_explanations"]
ORACLE["merge_audit_failed"] = with_prompts("""
SELECT CASE WHEN patient_id % 5 = 0 THEN 'failed' ELSE status END AS status, count(*) AS n FROM prompts GROUP BY 1""")
ORACLE["alerts_two_runs"] = with_scores(f"""
SELECT * FROM (WITH both_runs AS (
  SELECT r.* REPLACE (score_id + k * (SELECT count(*) FROM risk_scores) AS score_id), k
  FROM alert_rows r, (SELECT unnest([0, 1]) AS k) WHERE r.score_id IS NOT NULL
  UNION ALL
  SELECT *, admission_id % 2 FROM alert_rows WHERE score_id IS NULL
)
SELECT row_number() OVER (ORDER BY k, admission_id, type_ord, score_id NULLS FIRST) AS alert_id, patient_id, score_id, alert_type,
       severity, message, false AS is_acknowledged, CAST(NULL AS VARCHAR) AS acknowledged_by, {AS_OF_T} AS created_at, k = 1 AS is_second
FROM both_runs)""")

ORACLE["label_encode_wide"] = with_star("""
SELECT admission_id, CAST(dense_rank() OVER (ORDER BY coalesce(notes, 'Unknown')) - 1 AS BIGINT) AS notes FROM admissions""")
