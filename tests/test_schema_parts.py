"""Documents parsed with a part of the schema: the same values, and fewer fields to fill."""

import pytest

from checks import tables
from checks.queries import QUERIES, SUMMARY_SCHEMA, _document_summary
from tests.conftest import SMALL
from wardflow.operators import ccda
from tests.test_ccda import document, section


def people(*roles):
    return "".join(f"<recordTarget><patientRole>{role}</patientRole></recordTarget>" for role in roles)


def wrapped(content, body=""):
    return (f"<ClinicalDocument><title>t</title>{content}<component><structuredBody>{body}"
            "</structuredBody></component></ClinicalDocument>")


TEXTS = [
    document(section("Allergies", "Nuts"), section("Medications", "A &amp; B", "C"), given=("Ann", "X")),
    document(),
    wrapped(people('<id extension="e"/><id extension="f"/><addr><city>c</city></addr>')),
    wrapped(people('<id root="r"/><id extension="e"/>')),
    wrapped(people("<addr><state>s</state></addr><addr><city>c</city></addr>")),
    wrapped(people("<patient><name><suffix>J</suffix></name><name><given>g</given></name></patient>")),
    wrapped(people("", '<id extension="z"/>')),
    wrapped("", "<component><section><code code='1'/></section></component><component/>"),
    wrapped("", "<component><section><entry>text</entry><title><b>x</b>y</title></section></component>"),
    wrapped("<recordTarget>words</recordTarget>", "text"),
    "<ClinicalDocument/>", "", "garbage", "<ClinicalDocument><title>x</ClinicalDocument>", None,
]


def summaries(spark, schema):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "place int, value string")
    read = ccda.ccda_documents(frame, keep=["place"], schema=schema)
    return read.select("place", *_document_summary(), ccda.CORRUPT).orderBy("place").collect()


def test_summary_is_the_same_with_a_part_of_the_schema(spark):
    whole = summaries(spark, ccda.DOCUMENT_SCHEMA)
    assert summaries(spark, SUMMARY_SCHEMA) == whole
    assert whole[2].patient == "e" and whole[2].city == "c" and whole[0].sections == 2


def test_part_of_the_schema_has_only_what_is_named():
    part = ccda.document_schema("recordTarget.patientRole.addr.city", "title")
    assert part.simpleString() == (
        "struct<title:string,recordTarget:array<struct<patientRole:struct<addr:"
        "array<struct<city:string>>>>>,_corrupt_record:string>")
    assert "substanceAdministration" not in SUMMARY_SCHEMA.simpleString()
    for unknown in ("nothing", "title.text", "recordTarget.nobody"):
        with pytest.raises(ValueError, match="not in the document schema"):
            ccda.document_schema(unknown)


@pytest.mark.parametrize("name", ["xml_scan", "xml_scan_plain"])
def test_scans_fill_only_what_the_summary_reads(spark, name):
    whole = tables.scanned_documents(spark, SMALL).select(_document_summary())
    scanned = QUERIES[name](spark, SMALL)
    planned = scanned._jdf.queryExecution().optimizedPlan()
    read = planned.collectLeaves().head().schema().catalogString()
    assert "substanceAdministration" not in planned.toString() + read
    assert scanned.exceptAll(whole).isEmpty() and whole.exceptAll(scanned).isEmpty()
