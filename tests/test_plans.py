"""Named queries over empty tables, NULLs, filters and ties."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardflow.operators.terminology import terminology, terminology_enrich
from wardflow.plans import admissions, inventory, medications, omop
from wardflow.plans.common import optional_facility_filter

HL7 = (
    "patient_id string, admit_location string, admit_diagnosis string, message_type string, "
    "facility string, source_file string, parsed_at timestamp"
)
MEDICATIONS = "city string, first_name string, last_name string, medication_name string"
FEATURES = "person_id string, diabetes_ind int, hypertension_ind int, substance_use_ind int"
CONDITIONS = "person_id string, condition_source_value string"
AUDIT = (
    "row_count bigint, source_table string, target_table string, refresh_date string, "
    "ingested_at timestamp"
)

EMPTY = [
    (HL7, f) for f in (
        admissions.q_hl7_enriched, admissions.q_top_diagnoses_by_facility,
        admissions.q_admissions_by_facility, admissions.q_messages_by_facility,
        admissions.q_top_admit_diagnoses, admissions.q_top_admit_diagnoses_described,
        admissions.q_diagnosis_by_facility, admissions.q_recent_messages,
        admissions.q_recent_messages_described, admissions.q_facility_list,
    )
] + [
    (MEDICATIONS, f) for f in (
        medications.q_top_medications, medications.q_medication_frequency,
        medications.q_medications_by_city, medications.q_medication_records,
    )
] + [
    (FEATURES, omop.q_comorbidity_distribution), (FEATURES, omop.q_risk_tier_counts),
    (CONDITIONS, omop.q_conditions_enriched), (CONDITIONS, omop.q_condition_codes_described),
    (AUDIT, inventory.q_audit_recent), (AUDIT, inventory.q_last_ingest),
]


@pytest.mark.parametrize("schema, function", EMPTY, ids=lambda x: getattr(x, "__name__", ""))
def test_no_rows_in_no_rows_out(spark, schema, function):
    assert function(spark.createDataFrame([], schema)).collect() == []


TOTALS = [
    (MEDICATIONS, medications.q_kpi_ccda_documents, (0,)),
    (MEDICATIONS, medications.q_kpi_medications, (0, 0)),
    (CONDITIONS, omop.q_kpi_omop_patients, (0,)),
    (HL7, admissions.q_kpi_hl7, (0, 0)),
    (FEATURES, omop.q_prevalence_summary, (None, None, None, 0)),
    (FEATURES, omop.q_comorbid_pct, (0, 0, None)),
    (FEATURES, omop.q_diabetes_count, (0,)),
    (HL7, admissions.dq_hl7_completeness, (0, 0, 0, 0, None)),
    (CONDITIONS, omop.dq_snomed_validity, (0, 0, None)),
    (MEDICATIONS, medications.dq_ccda_completeness, (0, 0, 0, 0)),
]


@pytest.mark.parametrize("schema, function, expected", TOTALS, ids=lambda x: getattr(x, "__name__", ""))
def test_totals_over_no_rows(spark, schema, function, expected):
    assert [tuple(r) for r in function(spark.createDataFrame([], schema)).collect()] == [expected]


def test_prevalence_over_no_rows(spark):
    rows = omop.q_condition_prevalence(spark.createDataFrame([], FEATURES)).collect()
    assert {tuple(r) for r in rows} == {
        ("Diabetes", None), ("Hypertension", None), ("Substance Use", None)}


def hl7_rows(spark):
    at = datetime(2020, 1, 1)
    rows = [
        ("P1", "A", "I10", "ADT^A01", "A", "f", at),
        ("", "A", "", "ADT^A02", "A", "f", at),
        (None, "B", None, None, None, "f", at),
        ("P2", "B", "J18.9", "ADT^A01^ADT_A01", "B", "f", at),
        ("P3", "B", "I10", "XYZ", "O'Neil", "f", datetime(2021, 1, 1)),
    ]
    return spark.createDataFrame(rows, HL7)


def test_completeness_counts_null_and_empty(spark):
    row = admissions.dq_hl7_completeness(hl7_rows(spark)).first()
    assert tuple(row) == (5, 2, 2, 1, 60.0)


def test_admissions_need_the_event(spark):
    found = admissions.q_admissions_by_facility(hl7_rows(spark)).collect()
    assert [tuple(r) for r in found] == [("A", 1), ("B", 1)]


def test_facility_filter(spark):
    rows = hl7_rows(spark)
    assert optional_facility_filter(rows).count() == 5
    assert optional_facility_filter(rows, "All").count() == 5
    assert optional_facility_filter(rows, "O'Neil").count() == 1
    assert optional_facility_filter(rows, "x' OR '1'='1").count() == 0
    found = admissions.q_top_admit_diagnoses_described(rows, "A").collect()
    assert [tuple(r) for r in found] == [("I10", "Essential hypertension", 1)]


def test_facility_messages(spark):
    rows = admissions.q_facility_messages(hl7_rows(spark), "A")
    assert rows.count() == 2 and "parsed_at" not in rows.columns


def test_newest_come_first_and_ties_have_an_order(spark):
    recent = admissions.q_recent_messages(hl7_rows(spark), 3).collect()
    assert [r.patient_id for r in recent] == ["P3", None, ""]
    described = admissions.q_recent_messages_described(hl7_rows(spark), n=1).first()
    assert described.event_description == "Unknown ADT event: "


def test_audit_order(spark):
    rows = [(1, "a", "t", "2020-01-01", datetime(2020, 1, 1, 8)),
            (2, "b", "t", "2020-01-01", datetime(2020, 1, 1, 9)),
            (3, "c", "t", "2020-01-01", datetime(2020, 1, 1, 7))]
    audit = spark.createDataFrame(rows, AUDIT)
    assert [r.row_count for r in inventory.q_audit_recent(audit, 2).collect()] == [2, 1]
    assert tuple(inventory.q_last_ingest(audit).first()) == ("b", 2, "2020-01-01")


def test_medication_groups(spark):
    rows = [("C", "a", "b", None), ("C", "a", "c", None), ("D", "a", "b", "M"), (None, "a", "b", "M"),
            ("D", "a", "b", "L")]
    table = spark.createDataFrame(rows, MEDICATIONS)
    top = [tuple(r) for r in medications.q_top_medications(table, 2).collect()]
    every = [tuple(r) for r in medications.q_medication_frequency(table).collect()]
    cities = [tuple(r) for r in medications.q_medications_by_city(table).collect()]
    assert top == [("M", 2), ("L", 1)]
    assert every == [(None, 2), ("M", 2), ("L", 1)]
    assert cities == [("C", 2), ("D", 2)]


@pytest.mark.parametrize("system, values", [
    ("snomed", ["44054006", "999999999", "", None]),
    ("icd10", ["I10", "Z99.9", None]),
    ("adt", ["A01", "A99", "", None]),
    ("hedis", ["awv", "AWV", "XYZ", None]),
])
def test_lookup_join_equals_the_function(spark, system, values):
    from wardflow import functions as fn

    function = {"snomed": fn.snomed_description, "icd10": fn.icd10_description,
                "adt": fn.adt_event_description, "hedis": fn.hedis_measure_name}[system]
    frame = spark.createDataFrame([(x,) for x in values], "code string")
    joined = terminology_enrich(frame, "code", system)
    expected = frame.select("code", function(F.col("code")).alias("description"))
    assert joined.columns == ["code", "description", "code_system"]
    found = sorted((tuple(r) for r in joined.drop("code_system").collect()), key=repr)
    assert found == sorted((tuple(r) for r in expected.collect()), key=repr)


def test_terminology_size(spark):
    assert terminology(spark).count() == 49


@pytest.mark.parametrize("limit", [0, 200_000])
def test_codes_of_ones_own(spark, monkeypatch, limit):
    from wardflow.operators import terminology

    monkeypatch.setattr(terminology, "BROADCAST_CODES", limit)
    codes = spark.createDataFrame(
        [("icd10", "Z99.9", "Dependence"), ("icd10", "I10", "Own label"), ("icd10", "I10", "Zzz")],
        "system string, code string, description string")
    rows = spark.createDataFrame([("I10",), ("Z99.9",), ("J18.9",), ("X99",), (None,)], "c string")
    out = terminology.terminology_enrich(rows, "c", "icd10", codes)
    found = {r.c: r.description for r in out.collect()}
    assert found["I10"] == "Own label" and found["Z99.9"] == "Dependence"
    assert found["J18.9"] == "Pneumonia, unspecified organism" and found["X99"] == "X99"
