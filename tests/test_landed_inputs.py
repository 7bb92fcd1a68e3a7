"""Landed texts take a small part of their length on disk, in files of a bounded number of them."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from checks import inputs, tables
from tests.conftest import SMALL
from wardflow.operators import ccda
from wardflow.sources import files


def on_disk(folder):
    return sum(os.path.getsize(path) for path in glob.glob(f"{folder}/part-*"))


def test_landed_documents_are_small_and_whole(spark):
    texts = inputs.ccda_documents(spark, SMALL)
    count, size = texts.agg(F.count("*"), F.sum(F.octet_length("value"))).first()
    assert on_disk(tables.landed_documents(spark, SMALL)) < size / 10
    assert tables.scanned_documents(spark, SMALL).count() == count


@pytest.mark.parametrize("one_per_line", [True, False])
def test_compressed_documents_read_as_plain_ones(spark, tmp_path, one_per_line):
    texts = inputs.ccda_documents(spark, SMALL).select("value")
    texts.write.text(f"{tmp_path}/plain")
    tables.land_texts(texts, f"{tmp_path}/landed")
    plain, landed = (
        files.xml_scan(spark, f"{tmp_path}/{name}", ccda.ROW_TAG, ccda.DOCUMENT_SCHEMA, one_per_line)
        for name in ("plain", "landed"))
    assert landed.count() == plain.count()
    assert landed.exceptAll(plain).isEmpty() and plain.exceptAll(landed).isEmpty()


@pytest.mark.parametrize("make", [
    inputs.ccda_documents, inputs.fhir_bundles, inputs.patient_bundles, inputs.adt_messages])
def test_texts_are_made_by_as_many_tasks_as_their_number_asks_for(spark, monkeypatch, make):
    together = make(spark, SMALL)
    expected = sorted(r.value for r in together.select("value").collect())
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 100)
    apart = make(spark, SMALL).select("value")
    assert sorted(r.value for r in apart.collect()) == expected
    rows = [r["count"] for r in apart.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) > len(expected) / 200 and max(rows) < 200


def test_landed_bundles_are_small_and_whole(spark):
    texts = inputs.fhir_bundles(spark, SMALL)
    count, size = texts.agg(F.count("*"), F.sum(F.octet_length("value"))).first()
    landed = tables.landed_bundles(spark, SMALL)
    assert on_disk(landed) < size / 5
    assert files.fhir_bundle_scan(spark, f"{landed}/*", one_per_line=True).count() == count


def dealt_columns(df):
    """Columns of the rows of lines where they are dealt out, by the optimized plan."""
    found = []

    def walk(node):
        names = [node.output().apply(n).name() for n in range(node.output().size())]
        if node.nodeName() == "RepartitionByExpression":
            found.append(sorted(names))
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(df._jdf.queryExecution().optimizedPlan())
    return found


@pytest.mark.parametrize("make, expected", [
    (inputs.ccda_documents, ["c_custkey", "line", "medication", "n_name", "twice"]),
    (inputs.fhir_bundles, ["l_linenumber", "l_orderkey", "l_partkey", "l_shipdate", "l_suppkey", "o_custkey"])])
def test_lines_are_dealt_out_with_what_their_texts_need(spark, monkeypatch, make, expected):
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 100)
    assert expected in dealt_columns(make(spark, SMALL))
