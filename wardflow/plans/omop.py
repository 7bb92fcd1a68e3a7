"""Queries over the OMOP-style tables and ``condition_features``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.scalars import chronic_risk_tier, is_valid_snomed, snomed_description
from wardflow.plans.common import count_by, labelled_counts, percent

FLAGS = ["diabetes_ind", "hypertension_ind", "substance_use_ind"]
CONDITION_OF_FLAG = {
    "Diabetes": "diabetes_ind",
    "Hypertension": "hypertension_ind",
    "Substance Use": "substance_use_ind",
}


def _flag_sum() -> Column:
    return sum((F.col(flag) for flag in FLAGS[1:]), F.col(FLAGS[0]))


def q_kpi_omop_patients(person: DataFrame) -> DataFrame:
    return person.agg(F.count("*").alias("omop_patients"))


def q_omop_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = labelled_counts({(name,): df for name, df in tables.items()}, ["omop_table"])
    return counts.orderBy("omop_table")


def q_condition_prevalence(features: DataFrame) -> DataFrame:
    """Patients per condition: one pass over the flags, then turned into rows."""
    sums = features.agg(*[F.sum(flag).alias(flag) for flag in CONDITION_OF_FLAG.values()])
    pairs = [
        item for name, flag in CONDITION_OF_FLAG.items() for item in (F.lit(name), F.col(flag))
    ]
    return sums.select(F.stack(F.lit(len(CONDITION_OF_FLAG)), *pairs).alias("condition", "patients"))


def q_prevalence_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        F.sum("diabetes_ind").alias("diabetic_patients"),
        F.sum("hypertension_ind").alias("hypertensive_patients"),
        F.sum("substance_use_ind").alias("substance_use_patients"),
        F.count("*").alias("total_patients_with_flags"),
    )


def q_comorbidity_distribution(features: DataFrame) -> DataFrame:
    level = (
        F.when(_flag_sum() == 0, "No tracked conditions")
        .when(_flag_sum() == 1, "1 condition")
        .when(_flag_sum() == 2, "2 conditions")
        .otherwise("3 conditions")
    )
    return (
        features.groupBy(level.alias("comorbidity_level"))
        .agg(F.count("*").alias("patients"))
        .orderBy("comorbidity_level")
    )


def q_conditions_enriched(conditions: DataFrame, n: int = 50) -> DataFrame:
    """First conditions with label; the labels are looked up for the ``n`` rows only."""
    first = (
        conditions.select("person_id", F.col("condition_source_value").alias("code"))
        .orderBy("person_id", "code")
        .limit(int(n))
    )
    return first.select(
        "person_id",
        "code",
        snomed_description(F.col("code")).alias("description"),
        is_valid_snomed(F.col("code")).alias("valid_snomed"),
    )


def q_condition_codes_described(conditions: DataFrame) -> DataFrame:
    code = conditions.select(F.col("condition_source_value").alias("code"))
    return count_by(code, ["code"], "occurrences").select(
        "code", snomed_description(F.col("code")).alias("description"), "occurrences"
    )


def q_comorbid_pct(features: DataFrame) -> DataFrame:
    """Share of the patients in the table who have both diabetes and hypertension."""
    both = (F.col("diabetes_ind") == 1) & (F.col("hypertension_ind") == 1)
    counted = features.agg(
        F.count("*").alias("total_patients"), F.count_if(both).alias("both_conditions")
    )
    share = percent(F.col("both_conditions"), F.col("total_patients"))
    return counted.select("*", share.alias("both_pct"))


def q_diabetes_count(features: DataFrame) -> DataFrame:
    return features.agg(F.count_if(F.col("diabetes_ind") == 1).alias("diabetic_patients"))


def q_risk_tier_counts(features: DataFrame) -> DataFrame:
    tiers = features.select(chronic_risk_tier(_flag_sum()).alias("risk_tier"))
    return count_by(tiers, ["risk_tier"], "patients")


def dq_snomed_validity(conditions: DataFrame) -> DataFrame:
    counted = conditions.agg(
        F.count("*").alias("total_conditions"),
        F.count_if(is_valid_snomed(F.col("condition_source_value"))).alias("valid_snomed_codes"),
    )
    share = percent(F.col("valid_snomed_codes"), F.col("total_conditions"))
    return counted.select("*", share.alias("snomed_valid_pct"))
