"""Scalar functions over columns. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions import vocabulary as v


def _first_match(branches: Iterable[tuple[Column, str]], otherwise: Column | str) -> Column:
    """CASE: the value of the first condition that holds."""
    cases = F
    for condition, value in branches:
        cases = cases.when(condition, value)
    return cases.otherwise(otherwise)


def _described(code: Column, system: str, key: Column | None = None) -> Column:
    """Label of a code; without one the code itself, behind the system's prefix if it has one."""
    key = code if key is None else key
    prefix = v.UNKNOWN_PREFIX[system]
    labels = ((key == known, text) for known, text in v.TERMINOLOGY[system].items())
    return _first_match(labels, code if prefix is None else F.concat(F.lit(prefix), code))


def snomed_description(code: Column) -> Column:
    return _described(code, "snomed")


def icd10_description(code: Column) -> Column:
    return _described(code, "icd10")


def adt_event_description(event_code: Column) -> Column:
    return _described(event_code, "adt")


def hedis_measure_name(measure_code: Column) -> Column:
    """Measure name; the lookup ignores case, an unknown code is shown as given."""
    return _described(measure_code, "hedis", F.upper(measure_code))


def age_from_dob(birth_date: Column, as_of: Column | None = None, exact: bool = False) -> Column:
    """Age in whole years.

    The default divides days by 365.25 and so is one year short on some birthdays; ``exact``
    counts calendar years instead.
    """
    as_of = F.current_date() if as_of is None else as_of
    if exact:
        years = F.floor(F.months_between(as_of, birth_date) / 12)
    else:
        years = F.floor(F.datediff(as_of, birth_date) / F.lit(v.DAYS_PER_YEAR))
    return years.cast("int")


def chronic_risk_tier(condition_count: Column) -> Column:
    tiers = ((condition_count >= lower, label) for lower, label in v.RISK_TIERS)
    return _first_match(tiers, v.RISK_NONE)


def days_overdue_bucket(days_since_encounter: Column) -> Column:
    unknown = [(days_since_encounter.isNull(), v.OVERDUE_UNKNOWN)]
    limits = [(days_since_encounter <= upper, label) for upper, label in v.OVERDUE_LIMITS]
    return _first_match(unknown + limits, v.OVERDUE_BEYOND)


def is_valid_snomed(code: Column) -> Column:
    return code.rlike(v.SNOMED_FORMAT)


def is_valid_icd10(code: Column) -> Column:
    return code.rlike(v.ICD10_FORMAT)


def hl7_event_code(message_type: Column) -> Column:
    """``ADT^A01`` to ``A01``; empty if there is none."""
    return F.regexp_extract(message_type, v.ADT_EVENT_PATTERN, 0)


def code_system(code: Column) -> Column:
    """Vocabulary a code belongs to. The ADT list comes before the ICD-10 format, which it fits."""
    return (
        F.when(code.isNull(), F.lit(None).cast("string"))
        .when(is_valid_snomed(code), "snomed")
        .when(code.isin(list(v.ADT_EVENTS)), "adt")
        .when(is_valid_icd10(code), "icd10")
        .otherwise("unknown")
    )


def validate_codes(code: Column) -> Column:
    """Both format checks and a verdict text, as a struct."""
    snomed, icd10 = is_valid_snomed(code), is_valid_icd10(code)
    verdicts = F.concat_ws(
        ", ", F.when(snomed, v.VERDICT_SNOMED), F.when(icd10, v.VERDICT_ICD10)
    )
    verdict = (
        F.when(code.isNull() | (F.trim(code) == ""), "")
        .when(verdicts == "", v.VERDICT_NEITHER)
        .otherwise(verdicts)
    )
    return F.struct(
        snomed.alias("valid_snomed"), icd10.alias("valid_icd10"), verdict.alias("verdict")
    )


def mask_jdbc_url(url: Column, limit: int | None = None) -> Column:
    """Connection URL without credentials, shortened to ``limit`` characters (95 for the audit).

    Only properties that name the place or the kind of connection keep their value; any other
    may hold a secret. Where it is not clear what ends a value, more is hidden rather than less.
    """
    hidden = F.regexp_replace(url, r"//[^?;]*@", "//***@")
    # Thin drivers put user/password before the host.
    hidden = F.regexp_replace(hidden, r"(?i)(:(?:thin|oci8?)):[^:/@]+/[^@]*@", "$1:***@")
    shown = "|".join(v.SHOWN_URL_PROPERTIES)
    value = r"(?:\{[^}]*\}|[^;&]*)(?:[;&][^=;&?]*(?=[;&]|$))*"
    hidden = F.regexp_replace(hidden, rf"(?i)([?;&])(?!(?:{shown})=)([^=?;&]+)={value}", "$1$2=***")
    limit = v.AUDIT_URL_LENGTH if limit is None else limit
    return F.when(
        F.length(hidden) > limit, F.concat(F.substring(hidden, 1, limit), F.lit("..."))
    ).otherwise(hidden)
