"""Code lists, labels and limits that every other module takes from here."""

from __future__ import annotations

# --- Fixed values: clinical codes and the labels shown for them. ---

SNOMED = {
    "44054006": "Diabetes mellitus type 2",
    "73211009": "Diabetes mellitus type 1",
    "46635009": "Diabetes mellitus type 1.5",
    "59621000": "Essential hypertension",
    "88805009": "Chronic congestive heart failure",
    "13645005": "Chronic obstructive pulmonary disease",
    "709044004": "Chronic kidney disease",
    "427089005": "Diabetes mellitus due to genetic defect",
    "127013003": "Diabetic renal disease",
    "422034002": "Diabetic retinopathy",
    "55680006": "Drug overdose",
    "361055000": "Misuses drugs",
    "449868002": "Current every day smoker",
    "162673000": "General examination of patient",
    "185349003": "Encounter for check up",
    "410620009": "Well child visit",
    "50849002": "Emergency room admission",
    "32485007": "Hospital admission",
    "24623002": "Screening mammography",
    "73761001": "Colonoscopy",
}

ICD10 = {
    "I10": "Essential hypertension",
    "E11.9": "Type 2 diabetes mellitus without complications",
    "J44.1": "COPD with acute exacerbation",
    "I50.9": "Heart failure, unspecified",
    "N18.3": "Chronic kidney disease, stage 3",
    "S72.001A": "Fracture of unspecified part of neck of right femur",
    "J18.9": "Pneumonia, unspecified organism",
    "I21.9": "Acute myocardial infarction, unspecified",
    "I25.10": "Atherosclerotic heart disease of native coronary artery",
    "J96.01": "Acute respiratory failure with hypoxia",
    "K92.1": "Melena (GI bleed)",
}

ADT_EVENTS = {
    "A01": "Patient admitted",
    "A02": "Patient transferred",
    "A03": "Patient discharged",
    "A04": "Patient registered",
    "A05": "Patient pre-admitted",
    "A06": "Outpatient to inpatient transfer",
    "A07": "Inpatient to outpatient transfer",
    "A08": "Patient information updated",
    "A11": "Admission cancelled",
    "A13": "Discharge cancelled",
    "A28": "Person added",
    "A31": "Person information updated",
}

HEDIS = {
    "AWV": "Annual Wellness Visit",
    "BCS": "Breast Cancer Screening",
    "COL": "Colorectal Cancer Screening",
    "A1C": "HbA1c Management (<8%)",
    "CBP": "Controlling High Blood Pressure",
    "PCR": "Plan All-Cause Readmissions",
}

# Texts put before a code that has no label; None means the code itself is shown.
UNKNOWN_ADT_PREFIX = "Unknown ADT event: "
UNKNOWN_HEDIS_PREFIX = "Unknown measure: "

# Condition codes behind the three chronic-condition flags.
DIABETES_CODES = ["44054006", "427089005", "127013003", "422034002"]
HYPERTENSION_CODES = ["59621000"]
SUBSTANCE_USE_CODES = ["55680006", "361055000", "449868002"]

# Code formats and the ADT trigger event inside a message type.
SNOMED_FORMAT = r"^[0-9]{6,18}$"
ICD10_FORMAT = r"^[A-Z][0-9]{2}(\.[A-Z0-9]{1,4})?$"
ADT_EVENT_PATTERN = r"A[0-9]+"

# Days since the last encounter: upper limit (inclusive) and label.
OVERDUE_LIMITS = [
    (90, "0-90 days (active)"),
    (180, "91-180 days (at risk)"),
    (365, "181-365 days (overdue)"),
]
OVERDUE_BEYOND = "365+ days (lost to care)"
OVERDUE_UNKNOWN = "unknown"

# Number of chronic conditions: lower limit (inclusive) and tier, highest first.
RISK_TIERS = [(3, "high"), (2, "moderate"), (1, "low")]
RISK_NONE = "none"

# Verdict texts of the code check.
VERDICT_SNOMED = "Valid SNOMED"
VERDICT_ICD10 = "Valid ICD-10-CM"
VERDICT_NEITHER = "Not a recognized SNOMED or ICD-10 format"

DAYS_PER_YEAR = 365.25

# Length kept of a connection URL in the audit, and of the cause of a parse error.
AUDIT_URL_LENGTH = 95
PARSE_CAUSE_LENGTH = 100
PARSE_ERROR_PREFIX = "PARSE_ERROR: "

# --- End of fixed values. ---

# Properties of connection URLs that hold no secret.
SHOWN_URL_PROPERTIES = [
    "host", "port", "portNumber", "serverName", "instance", "instanceName", "db", "database",
    "databaseName", "catalog", "schema", "currentSchema", "warehouse", "ssl", "useSSL", "sslMode",
    "encrypt", "trustServerCertificate", "create",
]

TERMINOLOGY = {"snomed": SNOMED, "icd10": ICD10, "adt": ADT_EVENTS, "hedis": HEDIS}
UNKNOWN_PREFIX = {
    "snomed": None,
    "icd10": None,
    "adt": UNKNOWN_ADT_PREFIX,
    "hedis": UNKNOWN_HEDIS_PREFIX,
}
FEATURE_CODES = {
    "diabetes_ind": DIABETES_CODES,
    "hypertension_ind": HYPERTENSION_CODES,
    "substance_use_ind": SUBSTANCE_USE_CODES,
}


def sql_text(text: str) -> str:
    """A Spark SQL string literal for ``text``."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
