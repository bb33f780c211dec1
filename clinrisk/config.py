"""Run parameters and the fixed values the clinical pipeline must reproduce.

Everything in the FIXED VALUES block is domain data that has to equal the
original pipeline's for results to match: lookup dictionaries, lab reference
ranges, vital-sign distributions, literal strings and tier thresholds.  They
are stated here once, in their natural order, and every operator and oracle
query reads them from this module.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

# ---------------------------------------------------------------------------
# Run parameters (ours)
# ---------------------------------------------------------------------------

#: Reference date standing in for "now" (ages, created_at, scored_at).
AS_OF = _dt.date(2002, 1, 1)
_RUN_AS_OF: ContextVar[_dt.date | None] = ContextVar("as_of", default=None)
AS_OF_SQL_DATE = "DATE '2002-01-01'"
AS_OF_SQL_TS = "TIMESTAMP '2002-01-01 00:00:00'"

#: Seed mixed into every deterministic draw.
SEED = 42

#: Trees of a forest.
FULL_NUM_TREES = 200
MAX_DEPTH = 10

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the original pipeline's
# ---------------------------------------------------------------------------

#: Medical condition -> department; anything else -> DEFAULT_DEPARTMENT.
DEPARTMENTS = {
    "Cancer": "Oncology",
    "Diabetes": "Endocrinology",
    "Hypertension": "Cardiology",
    "Obesity": "General Ward",
    "Arthritis": "Orthopedics",
    "Asthma": "Pulmonology",
}
DEFAULT_DEPARTMENT = "General Ward"

#: Test result -> discharge status; anything else (NULL too) -> DEFAULT_DISCHARGE.
DISCHARGE_STATUS = {
    "Normal": "Recovered",
    "Abnormal": "Transferred",
    "Inconclusive": "Ongoing",
}
DEFAULT_DISCHARGE = "Recovered"

#: Medical condition -> ICD-10 code; anything else -> NULL.
ICD10 = {
    "Cancer": "C80.1",
    "Diabetes": "E11.9",
    "Hypertension": "I10",
    "Obesity": "E66.9",
    "Arthritis": "M19.90",
    "Asthma": "J45.50",
}

#: Drug -> dosage (default DEFAULT_DOSAGE) and drug -> route (default DEFAULT_ROUTE).
DOSAGE = {
    "Lipitor": "20mg",
    "Ibuprofen": "400mg",
    "Aspirin": "75mg",
    "Paracetamol": "500mg",
    "Penicillin": "500mg",
}
DEFAULT_DOSAGE = "Standard dose"
ROUTE = {
    "Lipitor": "Oral",
    "Ibuprofen": "Oral",
    "Aspirin": "Oral",
    "Paracetamol": "Oral",
    "Penicillin": "IV",
}
DEFAULT_ROUTE = "Oral"
FREQUENCY = "Once daily"

#: Admission-type replacement (others unchanged).
ADMISSION_TYPE_REPLACE = ("Urgent", "Emergency")

#: Lab templates in the original order: (test, min, max, unit, only-for-condition).
LAB_TEMPLATES = [
    ("HbA1c", 4.0, 6.4, "%", "Diabetes"),
    ("Creatinine", 0.6, 1.2, "mg/dL", None),
    ("WBC", 4.5, 11.0, "K/uL", None),
    ("Hemoglobin", 12.0, 17.5, "g/dL", None),
    ("Sodium", 136.0, 145.0, "mEq/L", None),
]
#: Upper end of an abnormal lab draw, as a multiple of the reference max.
ABNORMAL_LAB_FACTOR = 1.4

#: Vital-sign gaussians (mean, sd): (when-true, when-false) for the stated condition.
VITALS_HR = ((90.0, 15.0), (75.0, 10.0))          # abnormal test result
VITALS_SBP = ((145.0, 15.0), (120.0, 12.0))       # condition Hypertension
VITALS_DBP_GAP = (40.0, 5.0)                      # DBP = unclamped SBP - gap
VITALS_SPO2 = ((93.0, 2.0), (97.0, 1.5))          # Asthma and abnormal
VITALS_TEMP = ((37.8, 0.5), (36.8, 0.3))          # abnormal test result
VITALS_RR = ((20.0, 3.0), (16.0, 2.0))            # abnormal test result
VITALS_WEIGHT = ((90.0, 15.0), (72.0, 12.0))      # condition Obesity
VITALS_HEIGHT = (168.0, 10.0)
#: Clamp floors (and the SpO2 cap), then 1-decimal rounding.
VITALS_FLOOR = {
    "heart_rate": 40.0,
    "systolic_bp": 80.0,
    "diastolic_bp": 50.0,
    "temperature": 35.0,
    "spo2": 85.0,
    "respiratory_rate": 8.0,
    "weight_kg": 40.0,
    "height_cm": 140.0,
}
SPO2_CAP = 100.0

#: Synthetic patient contact data.
PHONE_RANGES = ((200, 999), (100, 999), (1000, 9999))
ADDRESS_NUMBER_RANGE = (1, 9999)
ADDRESS_SUFFIX = " Main St, City, State"
EMAIL_DOMAIN = "@email.com"
EMERGENCY_CONTACT = "Next of Kin"
NOTES_SEPARATOR = " | Billing: $"
WARD_PREFIX = "Ward "
WARD_COUNT = 5
DIAGNOSIS_TYPE = "Primary"

#: Scoring.
MODEL_VERSION = "rf_v1.0"
TIER_HIGH = 0.7
TIER_MEDIUM = 0.4
EMPTY_TOP_FEATURES = "[]"

#: Schema vocabularies (CHECK constraints).
GENDERS = ("Male", "Female", "Other")
ADMISSION_TYPES = ("Emergency", "Elective", "Outpatient")
DISCHARGE_STATUSES = ("Recovered", "Transferred", "Deceased", "LAMA", "Ongoing")
DIAGNOSIS_TYPES = ("Primary", "Secondary", "Comorbidity")
TIERS = ("Low", "Medium", "High")
ALERT_TYPES = ("Readmission", "Deterioration", "Mortality", "Abnormal Lab")
SEVERITIES = ("Low", "Medium", "High", "Critical")

#: Feature columns in model order (23).
CATEGORICAL_FEATURES = ["gender", "blood_type", "department", "admission_type"]
FEATURE_COLUMNS = [
    "age", "gender", "blood_type", "department", "admission_type", "los_days",
    "heart_rate", "systolic_bp", "diastolic_bp", "temperature", "spo2", "respiratory_rate",
    "diagnosis_count", "medication_count",
    "creatinine", "hba1c", "wbc", "hemoglobin", "sodium", "abnormal_labs",
    "pulse_pressure", "shock_index", "age_risk",
]
TARGETS = {"readmission": "readmitted_30d", "deterioration": "deteriorated", "mortality": "mortality"}

#: Readmission window (days); the start is exclusive, the end inclusive.
READMIT_DAYS = 30


def as_of() -> _dt.date:
    """The reference date of the run at hand."""
    return _RUN_AS_OF.get() or AS_OF


@contextmanager
def run_as_of(date: _dt.date | None) -> Iterator[None]:
    """Within the block, "now" is ``date``; other jobs of the process keep theirs."""
    token = _RUN_AS_OF.set(date or _RUN_AS_OF.get())
    try:
        yield
    finally:
        _RUN_AS_OF.reset(token)
