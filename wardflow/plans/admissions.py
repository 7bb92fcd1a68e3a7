"""Queries over ``parsed_hl7``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.scalars import adt_event_description, hl7_event_code, icd10_description
from wardflow.plans.common import (
    count_by,
    filled,
    missing,
    optional_facility_filter,
    percent,
    top_groups,
)
from wardflow.sources.distincts import DistinctStore

NEWEST_FIRST = ["parsed_at"]
MESSAGE = ["patient_id", "facility", "message_type", "admit_diagnosis", "admit_location"]


def _event_description() -> Column:
    return adt_event_description(hl7_event_code(F.col("message_type")))


def q_kpi_hl7(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count("*").alias("hl7_messages_parsed"), F.countDistinct("facility").alias("facilities")
    )


def q_kpi_hl7_loaded(store: DistinctStore) -> DataFrame:
    """``q_kpi_hl7`` over all loads of a store that counts ``facility``."""
    return store.counts([], "hl7_messages_parsed").withColumnRenamed("facility", "facilities")


def q_hl7_enriched(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "patient_id",
        "facility",
        "admit_diagnosis",
        icd10_description(F.col("admit_diagnosis")).alias("diagnosis_description"),
        "message_type",
        _event_description().alias("event_description"),
    )


def q_top_diagnoses_by_facility(parsed: DataFrame, n: int = 20) -> DataFrame:
    return top_groups(
        parsed.where(filled("admit_diagnosis")),
        ["admit_diagnosis", "facility"], "admission_count", n,
    )


def q_admissions_by_facility(parsed: DataFrame) -> DataFrame:
    """Messages with an A01 event per facility."""
    admitted = parsed.where(F.col("message_type").contains("A01"))
    return count_by(admitted, ["facility"], "admissions").orderBy(F.desc("admissions"), "facility")


def q_messages_by_facility(parsed: DataFrame, facility: str | None = None) -> DataFrame:
    """All messages per facility, whatever their event."""
    counted = count_by(optional_facility_filter(parsed, facility), ["facility"], "admissions")
    return counted.orderBy(F.desc("admissions"), "facility")


def q_top_admit_diagnoses(parsed: DataFrame, n: int = 10) -> DataFrame:
    return top_groups(
        parsed.where(filled("admit_diagnosis")), ["admit_diagnosis"], "frequency", n
    )


def q_top_admit_diagnoses_described(
    parsed: DataFrame, facility: str | None = None, n: int = 10
) -> DataFrame:
    """Most frequent diagnoses with label; the labels are looked up for the ``n`` groups only."""
    top = q_top_admit_diagnoses(optional_facility_filter(parsed, facility), n)
    return top.select(
        F.col("admit_diagnosis").alias("code"),
        icd10_description(F.col("admit_diagnosis")).alias("diagnosis"),
        "frequency",
    )


def q_diagnosis_by_facility(parsed: DataFrame) -> DataFrame:
    counted = count_by(
        parsed.where(filled("admit_diagnosis")), ["facility", "admit_diagnosis"], "admissions"
    )
    return counted.orderBy("facility", F.desc("admissions"), "admit_diagnosis")


def _newest(parsed: DataFrame, newest_by: list[str], n: int) -> DataFrame:
    order = [F.desc(name) for name in newest_by] + [F.col(name) for name in MESSAGE]
    return parsed.orderBy(*order).limit(int(n))


def q_recent_messages(
    parsed: DataFrame, n: int = 20, newest_by: list[str] = NEWEST_FIRST
) -> DataFrame:
    """Newest messages by the time they were parsed, or by other columns of the table."""
    return _newest(parsed, newest_by, n).select(*MESSAGE, *newest_by)


def q_recent_messages_described(
    parsed: DataFrame,
    facility: str | None = None,
    n: int = 20,
    newest_by: list[str] = NEWEST_FIRST,
) -> DataFrame:
    newest = _newest(optional_facility_filter(parsed, facility), newest_by, n)
    return newest.select(
        "patient_id",
        "facility",
        "message_type",
        "admit_diagnosis",
        icd10_description(F.col("admit_diagnosis")).alias("diagnosis_name"),
        _event_description().alias("event_description"),
        *newest_by,
    )


def q_facility_list(parsed: DataFrame) -> DataFrame:
    known = parsed.where(F.col("facility").isNotNull())
    return known.select("facility").distinct().orderBy("facility")


def q_facility_messages(parsed: DataFrame, facility: str) -> DataFrame:
    """The messages of one facility, without the time of parsing."""
    return parsed.where(F.col("facility") == F.lit(facility)).drop("parsed_at")


def dq_hl7_completeness(parsed: DataFrame) -> DataFrame:
    counted = parsed.agg(
        F.count("*").alias("total_messages"),
        F.count_if(missing("patient_id")).alias("missing_patient_id"),
        F.count_if(missing("admit_diagnosis")).alias("missing_diagnosis"),
        F.count_if(missing("facility")).alias("missing_facility"),
    )
    present = F.col("total_messages") - F.col("missing_patient_id")
    share = percent(present, F.col("total_messages"))
    return counted.select("*", share.alias("patient_id_completeness_pct"))
