"""Clinical vocabulary and scalar functions, as Column helpers and as SQL functions."""

from wardflow.functions.registry import list_functions, register_functions
from wardflow.functions.scalars import (
    adt_event_description,
    age_from_dob,
    chronic_risk_tier,
    code_system,
    days_overdue_bucket,
    hedis_measure_name,
    hl7_event_code,
    icd10_description,
    is_valid_icd10,
    is_valid_snomed,
    mask_jdbc_url,
    snomed_description,
    validate_codes,
)

__all__ = [
    "adt_event_description",
    "age_from_dob",
    "chronic_risk_tier",
    "code_system",
    "days_overdue_bucket",
    "hedis_measure_name",
    "hl7_event_code",
    "icd10_description",
    "is_valid_icd10",
    "is_valid_snomed",
    "list_functions",
    "mask_jdbc_url",
    "register_functions",
    "snomed_description",
    "validate_codes",
]
