"""C-CDA documents: one or many of each element, missing and malformed parts, files."""

from wardflow.operators import ccda
from wardflow.sources import files


def entry(name):
    shown = f' displayName="{name}"' if name is not None else ""
    return (
        "<entry><substanceAdministration><consumable><manufacturedProduct><manufacturedMaterial>"
        f'<code code="1"{shown}/></manufacturedMaterial></manufacturedProduct></consumable>'
        "</substanceAdministration></entry>"
    )


def section(title, *names):
    body = "".join(entry(name) for name in names)
    return f"<component><section><title>{title}</title>{body}</section></component>"


def document(*sections, given=("Ann",), city="Lakeside", namespace=' xmlns="urn:hl7-org:v3"'):
    names = "".join(f"<given>{g}</given>" for g in given)
    place = f"<city>{city}</city>" if city else ""
    return (
        f"<ClinicalDocument{namespace}><recordTarget><patientRole><addr>{place}</addr><patient>"
        f"<name>{names}<family>Lee</family></name></patient></patientRole></recordTarget>"
        f"<component><structuredBody>{''.join(sections)}</structuredBody></component>"
        "</ClinicalDocument>"
    )


def parsed(spark, *texts):
    return ccda.ccda_documents(spark.createDataFrame([(t,) for t in texts], "value string"))


def medications(spark, *texts):
    found = ccda.ccda_medications(parsed(spark, *texts)).collect()
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    narrow = ccda.ccda_documents(frame, schema=ccda.MEDICATION_SCHEMA)
    assert sorted(ccda.ccda_medications(narrow).collect(), key=repr) == sorted(found, key=repr)
    return sorted(map(tuple, found), key=repr)


def test_one_component_one_entry(spark):
    assert medications(spark, document(section("Medications", "Aspirin"))) == [
        ("Lakeside", "Ann", "Lee", "Aspirin")]


def test_many_components_and_entries(spark):
    text = document(
        section("Allergies", "Nuts"), section("Medications", "A &amp; B", "C", "C", None),
        given=("Ann", "X"),
    )
    assert medications(spark, text) == [
        ("Lakeside", "Ann", "Lee", "A & B"), ("Lakeside", "Ann", "Lee", "C"),
        ("Lakeside", "Ann", "Lee", None),
    ]


def test_rows_are_distinct_across_documents(spark):
    text = document(section("Medications", "A"))
    assert medications(spark, text, text, document(section("Medications", "A"), city=None)) == [
        ("Lakeside", "Ann", "Lee", "A"), (None, "Ann", "Lee", "A")]


def test_no_medications(spark):
    texts = [document(), document(section("Allergies", "Nuts")), document(section("Medications"))]
    assert medications(spark, *texts) == []


def test_malformed_text_keeps_its_row(spark):
    bad = ["<ClinicalDocument><id", "plain"]
    assert medications(spark, *bad, None) == []
    rows = parsed(spark, *bad, document()).collect()
    assert [r[ccda.CORRUPT] is not None for r in rows] == [True, True, False]
    assert rows[0].recordTarget is None


def test_sections(spark):
    rows = ccda.ccda_sections(parsed(spark, document(section("A", "x", "y"), section("B")))).collect()
    assert [(r.title, len(r.entries or [])) for r in rows] == [("A", 2), ("B", 0)]


def test_files_read_as_the_text_column_does(spark, tmp_path):
    texts = [document(section("Medications", f"M{i}", "Both"), city=f"C{i}") for i in range(5)]
    for number, text in enumerate(texts):
        (tmp_path / f"{number}.xml").write_text(
            '<?xml version="1.0"?>\n' + text.replace("><", ">\n<"))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "all.xml").write_text("\n".join(texts))
    expected = medications(spark, *texts)
    for path, one_per_line in ((f"{tmp_path}/*.xml", False), (f"{tmp_path}/lines", True)):
        scanned = files.xml_scan(spark, path, ccda.ROW_TAG, ccda.DOCUMENT_SCHEMA, one_per_line)
        assert scanned.count() == 5
        found = sorted(map(tuple, ccda.ccda_medications(scanned).collect()), key=repr)
        assert found == expected


def test_the_first_of_repeated_elements_counts_and_none_is_lost(spark):
    def role(city, name, number):
        return (f'<recordTarget><patientRole><id extension="{number}"/><id extension="x"/>'
                f"<addr><city>{city}</city></addr><addr><city>OLD</city></addr><patient>"
                f"<name><given>{name}</given><family>A</family></name><name><given>B</given>"
                "<family>MAIDEN</family></name></patient></patientRole></recordTarget>")

    text = f"<ClinicalDocument>{role('HERE', 'C', 'p1')}{role('THERE', 'D', 'p2')}</ClinicalDocument>"
    documents = ccda.ccda_documents(spark.createDataFrame([(text,)], "value string"))
    row = documents.select(ccda.patient_address()["city"].alias("city"), ccda.patient_name().alias("name"),
                           ccda.patient_role()["id"].alias("ids"), "recordTarget").first()
    assert (row.city, row.name.given, row.name.family) == ("HERE", ["C"], "A")
    assert [i._extension for i in row.ids] == ["p1", "x"]
    assert [[a.city for a in t.patientRole.addr] for t in row.recordTarget] == [["HERE", "OLD"], ["THERE", "OLD"]]
