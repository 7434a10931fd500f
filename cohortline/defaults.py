"""Default names, codes and limits. Operators take them as arguments."""

from __future__ import annotations

# Names of the key, time and label columns.
SUBJECT = "patient_id"
EVENT_ID = "event_id"
TIME = "observation_date"
LABEL = "readmission_30day"
TIMELINE = (TIME, EVENT_ID)

# Columns that never are features.
NON_FEATURES = (
    "patient_id", "event_id", "observation_date", "admission_date",
    "discharge_date", "readmission_30day",
)

# Column groups of the wide observation table.
NUMERIC = (
    "age", "bmi", "blood_pressure_systolic", "blood_pressure_diastolic",
    "heart_rate", "respiratory_rate", "oxygen_saturation", "temperature",
    "white_blood_cell_count", "hemoglobin", "platelet_count", "creatinine",
    "glucose", "length_of_stay", "num_prior_admissions", "num_medications",
    "num_procedures", "num_diagnoses",
)
CATEGORICAL = (
    "gender", "race", "admission_type", "insurance_type",
    "primary_diagnosis", "discharge_disposition", "icu_stay",
)
INDICATORS = (
    "has_diabetes", "has_hypertension", "has_chd", "has_copd",
    "has_renal_disease", "smoker",
)

# Event code vocabulary.
CODE_PREFIX = {
    "diagnosis": "DIAG/", "medication": "MED/", "procedure": "PROC/",
    "lab": "LAB/", "vital": "VITAL/",
}
MEASUREMENT_CODES = {
    "bmi": ("vital", "BMI"),
    "blood_pressure_systolic": ("vital", "BP_SYSTOLIC"),
    "blood_pressure_diastolic": ("vital", "BP_DIASTOLIC"),
    "heart_rate": ("vital", "HEART_RATE"),
    "respiratory_rate": ("vital", "RESP_RATE"),
    "oxygen_saturation": ("vital", "O2_SAT"),
    "temperature": ("vital", "TEMPERATURE"),
    "white_blood_cell_count": ("lab", "WBC"),
    "hemoglobin": ("lab", "HEMOGLOBIN"),
    "platelet_count": ("lab", "PLATELETS"),
    "creatinine": ("lab", "CREATININE"),
    "glucose": ("lab", "GLUCOSE"),
}
CATEGORY_KINDS = {
    "admission_type": "procedure",
    "insurance_type": "procedure",
    "primary_diagnosis": "diagnosis",
    "discharge_disposition": "procedure",
}
INDICATOR_CODES = {
    "has_diabetes": ("diagnosis", "DIABETES"),
    "has_hypertension": ("diagnosis", "HYPERTENSION"),
    "has_chd": ("diagnosis", "CHD"),
    "has_copd": ("diagnosis", "COPD"),
    "has_renal_disease": ("diagnosis", "RENAL"),
    "smoker": ("diagnosis", "SMOKER"),
}
UNKNOWN_SUBJECT = "UNKNOWN"
EVENT_SCHEMA_VERSION = "0.3"

# Serving fields in model order -> (low, high, value when missing).
# The first field is required and has no default.
FIELD_RULES = {
    "age": (0, 120, None),
    "bmi": (10, 60, 26.0),
    "blood_pressure_systolic": (60, 250, 120.0),
    "blood_pressure_diastolic": (30, 150, 80.0),
    "heart_rate": (30, 200, 75.0),
    "respiratory_rate": (8, 40, 16.0),
    "oxygen_saturation": (70, 100, 97.0),
    "temperature": (90, 110, 98.6),
    "white_blood_cell_count": (0, 50, 7.0),
    "hemoglobin": (3, 20, 13.5),
    "platelet_count": (10, 600, 250.0),
    "creatinine": (0.1, 15, 1.0),
    "glucose": (30, 600, 100.0),
    "length_of_stay": (0, 365, 3.0),
    "num_prior_admissions": (0, 50, 0.0),
    "num_medications": (0, 50, 5.0),
    "num_procedures": (0, 20, 0.0),
    "num_diagnoses": (0, 30, 2.0),
    "has_diabetes": (0, 1, 0.0),
    "has_hypertension": (0, 1, 0.0),
    "has_chd": (0, 1, 0.0),
    "has_copd": (0, 1, 0.0),
    "has_renal_disease": (0, 1, 0.0),
    "smoker": (0, 1, 0.0),
}

# Age bands and their two label sets.
AGE_EDGES = (0, 18, 35, 50, 65, 80, 120)
AGE_LABELS = ("pediatric", "young_adult", "adult", "middle_aged", "senior", "elderly")
AGE_RANGE_LABELS = ("0-18", "19-35", "36-50", "51-65", "66-80", "80+")

# Weights of the two comorbidity scores.
CHARLSON_WEIGHTS = {
    "has_diabetes": 1, "has_chd": 2, "has_copd": 1,
    "has_renal_disease": 2, "has_hypertension": 1,
}
ELIXHAUSER_INDICATORS = (
    "has_diabetes", "has_hypertension", "has_chd", "has_copd", "has_renal_disease",
)

# Timeline and polynomial features.
ROLLING_COLUMNS = (
    "heart_rate", "blood_pressure_systolic", "oxygen_saturation",
    "respiratory_rate", "temperature",
)
ROLLING_WINDOWS = (6, 12, 24, 48)
DIFF_COLUMNS = (
    "heart_rate", "blood_pressure_systolic", "oxygen_saturation",
    "creatinine", "glucose", "temperature",
)
POLYNOMIAL_COLUMNS = ("age", "bmi", "creatinine", "glucose", "length_of_stay")

# Risk and ablation buckets (upper bounds, exclusive).
RISK_BOUNDS = ((0.3, "low"), (0.6, "moderate"))
RISK_TOP = "high"
IMPACT_BOUNDS = ((-0.05, "critical"), (-0.02, "significant"), (0.0, "minor"))
IMPACT_TOP = "neutral"

# Metrics kept in run records.
RUN_METRICS = (
    "accuracy", "precision", "recall", "f1_score", "auc_roc",
    "specificity", "balanced_accuracy",
)
