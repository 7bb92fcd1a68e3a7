"""Queries over the C-CDA tables ``ccda_claims_raw`` and ``medications``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.plans.common import top_groups
from wardflow.sources.distincts import DistinctStore

RECORD = ["city", "first_name", "last_name", "medication_name"]


def q_kpi_ccda_documents(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count("*").alias("ccda_documents_loaded"))


def q_kpi_medications(medications: DataFrame) -> DataFrame:
    return medications.agg(
        F.count("*").alias("medications_extracted"),
        F.countDistinct("medication_name").alias("distinct_medications"),
    )


def q_kpi_medications_loaded(store: DistinctStore) -> DataFrame:
    """``q_kpi_medications`` over all loads of a store that counts ``medication_name``."""
    return store.counts([], "medications_extracted").withColumnRenamed(
        "medication_name", "distinct_medications")


def q_top_medications(medications: DataFrame, n: int = 15) -> DataFrame:
    """Most frequent medications. ``patient_count`` counts rows, which are distinct by patient
    name and city; two patients of one name in one city count once."""
    known = medications.where(F.col("medication_name").isNotNull())
    return top_groups(known, ["medication_name"], "patient_count", n)


def q_medication_frequency(medications: DataFrame, n: int = 20) -> DataFrame:
    """As ``q_top_medications``, with the rows without a name as a group of their own."""
    return top_groups(medications, ["medication_name"], "patient_count", n)


def q_medications_by_city(medications: DataFrame, n: int = 10) -> DataFrame:
    known = medications.where(F.col("city").isNotNull())
    return top_groups(known, ["city"], "prescription_count", n)


def q_medication_records(medications: DataFrame, n: int = 50) -> DataFrame:
    return medications.select(RECORD).orderBy(RECORD).limit(int(n))


def dq_ccda_completeness(medications: DataFrame) -> DataFrame:
    return medications.agg(
        F.count("*").alias("total_records"),
        *[
            F.count_if(F.col(name).isNull()).alias(f"null_{name}")
            for name in ("medication_name", "city", "first_name")
        ],
    )
