"""What the physical plans must and must not contain at any scale."""

import pytest
from pyspark.sql import functions as F

from checks import inputs, tables
from checks.queries import QUERIES
from tests.conftest import SMALL
from wardflow.operators import ccda, fhir
from wardflow.operators.hl7 import SEGMENT_PARENTS, hl7_parse_adt, hl7_segments
from wardflow.operators.terminology import terminology_enrich
from wardflow.plans import admissions, medications, omop


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_cross_join_no_single_task_window(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin", "Window"):
        assert unwanted not in text


def test_parse_is_narrow(spark):
    text = plan(hl7_parse_adt(inputs.adt_messages(spark, SMALL)))
    assert "Exchange" not in text


@pytest.mark.parametrize("parents", [None, SEGMENT_PARENTS])
def test_messages_are_made_once_and_behind_the_shuffle(spark, monkeypatch, parents):
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 100)
    segments = hl7_segments(inputs.adt_messages(spark, SMALL), keep=["o_orderkey"], parents=parents)
    text = segments._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("garbage") == 1 and "garbage" not in text[text.index("RepartitionByExpression"):]


def test_aggregates_are_partial_before_the_shuffle(spark):
    text = plan(admissions.q_top_admit_diagnoses(tables.parsed_hl7(spark, SMALL)))
    assert text.count("HashAggregate") == 2 and "partial_count" in text
    assert "TakeOrderedAndProject" in text


def test_queries_read_only_their_columns(spark):
    text = plan(admissions.q_top_admit_diagnoses(tables.parsed_hl7(spark, SMALL)))
    assert "ReadSchema: struct<admit_diagnosis:string>" in text
    assert "PushedFilters: [IsNotNull(admit_diagnosis), Not(EqualTo(admit_diagnosis,))]" in text
    text = plan(medications.q_top_medications(tables.medications(spark, SMALL)))
    assert "ReadSchema: struct<medication_name:string>" in text


def test_counts_read_no_columns(spark):
    text = plan(omop.q_omop_row_counts(tables.omop(spark, SMALL)))
    assert text.count("ReadSchema: struct<>") == 4


def test_prevalence_scans_once(spark):
    text = plan(omop.q_condition_prevalence(tables.features(spark, SMALL)))
    assert text.count("FileScan") == 1


def test_lookup_join_does_not_shuffle(spark):
    codes = inputs.table(spark, SMALL, "orders").select(F.col("o_orderstatus").alias("code"))
    text = plan(terminology_enrich(codes, "code", "adt"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_medications_shuffle_once_and_filter_between_the_explodes(spark):
    documents = ccda.ccda_documents(
        inputs.table(spark, SMALL, "documents").select(F.col("text").alias("value")))
    text = plan(ccda.ccda_medications(documents))
    assert text.count("hashpartitioning") == 1 and text.count("Generate explode") == 2
    order = [text.index("Generate explode"), text.index("= Medications"),
             text.rindex("Generate explode")]
    assert order == sorted(order)


def test_persons_shuffle_once_with_a_partial_aggregate(spark):
    bundles = inputs.table(spark, SMALL, "documents").select(F.col("text").alias("value"))
    text = plan(fhir.fhir_to_person(fhir.fhir_entries(bundles, kinds=["Patient"])))
    assert text.count("hashpartitioning") == 1 and "partial_max" in text


def test_staged_resources_are_pruned_by_kind_and_column(spark):
    tables.omop(spark, SMALL)
    staged = spark.table(f"{tables.database(spark, SMALL, 'fhir')}.fhir_resources")
    text = plan(fhir.fhir_to_condition_occurrence(staged))
    assert "EqualTo(resourceType,Condition)" in text
    assert "birthDate" not in text and "performedDateTime" not in text
