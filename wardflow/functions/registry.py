"""The nine scalar functions as SQL functions, written from the same tables as the helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.functions import vocabulary as v


def _case(subject: str, system: str, code: str) -> str:
    branches = " ".join(
        f"WHEN {v.sql_text(known)} THEN {v.sql_text(text)}"
        for known, text in v.TERMINOLOGY[system].items()
    )
    prefix = v.UNKNOWN_PREFIX[system]
    other = code if prefix is None else f"concat({v.sql_text(prefix)}, {code})"
    return f"CASE {subject} {branches} ELSE {other} END"


def _risk_tier(count: str) -> str:
    branches = " ".join(
        f"WHEN {count} >= {lower} THEN {v.sql_text(tier)}" for lower, tier in v.RISK_TIERS
    )
    return f"CASE {branches} ELSE {v.sql_text(v.RISK_NONE)} END"


def _overdue(days: str) -> str:
    branches = " ".join(
        f"WHEN {days} <= {upper} THEN {v.sql_text(label)}" for upper, label in v.OVERDUE_LIMITS
    )
    return (
        f"CASE WHEN {days} IS NULL THEN {v.sql_text(v.OVERDUE_UNKNOWN)} {branches} "
        f"ELSE {v.sql_text(v.OVERDUE_BEYOND)} END"
    )


def _definitions() -> list[tuple[str, str, str, str, str]]:
    """Name, parameters, result type, comment and body of each function."""
    return [
        ("snomed_description", "code STRING", "STRING",
         "Label of a SNOMED CT code, or the code itself", _case("code", "snomed", "code")),
        ("icd10_description", "code STRING", "STRING",
         "Label of an ICD-10-CM code, or the code itself", _case("code", "icd10", "code")),
        ("adt_event_description", "event_code STRING", "STRING",
         "Meaning of an ADT event code", _case("event_code", "adt", "event_code")),
        ("age_from_dob", "birth_date DATE, as_of DATE DEFAULT current_date()", "INT",
         "Age in years: days divided by 365.25",
         f"CAST(floor(datediff(as_of, birth_date) / {v.DAYS_PER_YEAR}) AS INT)"),
        ("chronic_risk_tier", "condition_count INT", "STRING",
         "Risk tier for a number of chronic conditions", _risk_tier("condition_count")),
        ("days_overdue_bucket", "days_since_encounter INT", "STRING",
         "Engagement bucket for the days since the last encounter",
         _overdue("days_since_encounter")),
        ("hedis_measure_name", "measure_code STRING", "STRING",
         "Name of a HEDIS measure, case ignored",
         _case("upper(measure_code)", "hedis", "measure_code")),
        ("is_valid_snomed", "code STRING", "BOOLEAN",
         "Whether a code has the SNOMED CT format", f"code RLIKE r'{v.SNOMED_FORMAT}'"),
        ("is_valid_icd10", "code STRING", "BOOLEAN",
         "Whether a code has the ICD-10-CM format", f"code RLIKE r'{v.ICD10_FORMAT}'"),
    ]


def register_functions(spark: SparkSession, database: str = "functions") -> list[str]:
    """Create or replace the functions in ``database``; returns their qualified names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for name, parameters, result, comment, body in _definitions():
        spark.sql(
            f"CREATE OR REPLACE FUNCTION `{database}`.`{name}`({parameters}) RETURNS {result} "
            f"COMMENT {v.sql_text(comment)} RETURN {body}"
        )
        names.append(f"{database}.{name}")
    return names


def list_functions(spark: SparkSession, database: str = "functions") -> DataFrame:
    return spark.sql(f"SHOW USER FUNCTIONS IN `{database}`")
