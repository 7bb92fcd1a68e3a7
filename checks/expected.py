"""Expected labels and code sets, written out apart from the library that is checked."""

from __future__ import annotations

# --- Fixed values: labels and code sets that results must show. ---

TERMINOLOGY = {
    "snomed": {
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
    },
    "icd10": {
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
    },
    "adt": {
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
    },
    "hedis": {
        "AWV": "Annual Wellness Visit",
        "BCS": "Breast Cancer Screening",
        "COL": "Colorectal Cancer Screening",
        "A1C": "HbA1c Management (<8%)",
        "CBP": "Controlling High Blood Pressure",
        "PCR": "Plan All-Cause Readmissions",
    },
}
UNKNOWN_PREFIX = {
    "snomed": None,
    "icd10": None,
    "adt": "Unknown ADT event: ",
    "hedis": "Unknown measure: ",
}
DIABETES_CODES = ["44054006", "427089005", "127013003", "422034002"]
HYPERTENSION_CODES = ["59621000"]
SUBSTANCE_USE_CODES = ["55680006", "361055000", "449868002"]

# --- End of fixed values. ---
