"""FHIR Bundles to OMOP-style tables: edge resources, references, repeated patients."""

import json
import uuid
from datetime import date, datetime

import pytest

from checks import inputs
from tests.conftest import SMALL
from wardflow.operators import fhir
from wardflow.sources import files

SNOMED = "http://snomed.info/sct"


def bundle(*resources):
    return json.dumps({"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]})


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(df):
    return [row.asDict() for row in df.collect()]


def test_odd_bundles_have_no_entries(spark):
    texts = ["", "not json", "{}", '{"entry": []}', None, '{"entry": [{}]}', "[1]"]
    assert fhir.fhir_entries(frame(spark, *texts)).count() == 0


def test_other_resources_are_left_out(spark):
    text = bundle({"resourceType": "Observation", "id": "o"}, {"resourceType": "Patient", "id": "p"})
    assert [r["id"] for r in rows(fhir.fhir_entries(frame(spark, text)))] == ["p"]


def test_person_newest_copy_counts(spark):
    def patient(day, gender):
        return {"resourceType": "Patient", "id": "p1", "gender": gender,
                "birthDate": "1980-02-03", "meta": {"lastUpdated": day}}

    texts = [bundle(patient("2020-01-01", "male")), bundle(patient("2021-01-01", "female")),
             bundle(patient("2020-06-01", "other"))]
    assert rows(fhir.fhir_to_person(fhir.fhir_entries(frame(spark, *texts)))) == [{
        "person_id": "p1", "gender_source_value": "female", "year_of_birth": 1980,
        "month_of_birth": 2, "day_of_birth": 3, "birth_datetime": date(1980, 2, 3),
    }]


@pytest.mark.parametrize("born, expected", [
    ("1980", (1980, None, None, None)),
    ("1980-05", (1980, 5, None, None)),
    (None, (None, None, None, None)),
    ("unknown", (None, None, None, None)),
])
def test_partial_birth_dates(spark, born, expected):
    text = bundle({"resourceType": "Patient", "id": "p", "birthDate": born})
    row = rows(fhir.fhir_to_person(fhir.fhir_entries(frame(spark, text))))[0]
    names = ("year_of_birth", "month_of_birth", "day_of_birth", "birth_datetime")
    assert tuple(row[name] for name in names) == expected


def condition(key, codings, subject="Patient/p1", **other):
    code = {"coding": codings} if codings is not None else None
    resource = {"resourceType": "Condition", "id": key, "code": code,
                "subject": {"reference": subject}, **other}
    return {k: x for k, x in resource.items() if x is not None}


def test_conditions(spark):
    text = bundle(
        condition("first", [{"system": SNOMED, "code": "1"}, {"system": SNOMED, "code": "2"}]),
        condition("snomed", [{"system": "other", "code": "X"}, {"system": SNOMED, "code": "3"}],
                  subject="urn:uuid:p2", onsetDateTime="2020-03-04T10:00:00-05:00"),
        condition("other", [{"system": "other", "code": "Y"}], subject="https://h:80/fhir/Patient/p3/_history/2",
                  recordedDate="2020-05-06", encounter={"reference": "Encounter/e1"}),
        condition("empty", []),
        condition("none", None, subject=None),
    )
    table = fhir.fhir_to_condition_occurrence(fhir.fhir_entries(frame(spark, text)))
    found = {r["condition_occurrence_id"]: r for r in rows(table)}
    assert {k: r["condition_source_value"] for k, r in found.items()} == {
        "first": "1", "snomed": "3", "other": "Y", "empty": None, "none": None}
    assert [found[k]["person_id"] for k in ("first", "snomed", "other")] == ["p1", "p2", "p3"]
    assert found["none"]["person_id"] is None
    assert found["snomed"]["condition_start_date"] == date(2020, 3, 4)
    assert found["other"]["condition_start_date"] == date(2020, 5, 6)
    assert found["other"]["visit_occurrence_id"] == "e1"


def test_procedures_and_visits(spark):
    text = bundle(
        {"resourceType": "Procedure", "id": "x", "performedPeriod": {"start": "2019-01-02T00:00:00Z"},
         "code": {"coding": [{"code": "73761001"}]}, "subject": {"reference": "Patient/p"}},
        {"resourceType": "Encounter", "id": "e", "class": {"code": "AMB"},
         "subject": {"reference": "Patient/p"},
         "period": {"start": "2019-01-02T10:00:00+02:00", "end": "not a time"}},
    )
    entries = fhir.fhir_entries(frame(spark, text))
    procedure = rows(fhir.fhir_to_procedure_occurrence(entries))[0]
    assert procedure["procedure_date"] == date(2019, 1, 2)
    assert procedure["procedure_source_value"] == "73761001"
    visit = fhir.fhir_to_visit_occurrence(entries)
    start = visit.selectExpr("cast(visit_start_datetime as string) as s", "visit_end_datetime as e")
    assert start.first().s == "2019-01-02 08:00:00" and start.first().e is None
    assert visit.first().visit_source_value == "AMB"


def test_features_for_all_persons(spark):
    conditions = spark.createDataFrame(
        [("a", "44054006"), ("a", "59621000"), ("b", "162673000"), ("c", "449868002"),
         ("a", "44054006")],
        "person_id string, condition_source_value string",
    )
    persons = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "person_id string")
    tracked = {tuple(r) for r in fhir.condition_features(conditions).collect()}
    assert tracked == {("a", 1, 1, 0), ("c", 0, 0, 1)}
    everyone = {tuple(r) for r in fhir.condition_features(conditions, persons, True).collect()}
    assert everyone == tracked | {("b", 0, 0, 0), ("d", 0, 0, 0)}
    with pytest.raises(ValueError):
        fhir.condition_features(conditions, include_all=True)


def test_load_parses_once_and_gives_what_the_transforms_give(spark, tmp_path):
    name = f"load_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    path = f"{tmp_path}/bundles"
    inputs.fhir_bundles(spark, SMALL).write.text(path)
    bundles = files.fhir_bundle_scan(spark, f"{path}/*.txt", one_per_line=True)
    loaded = fhir.load_omop(bundles, name)
    entries = fhir.fhir_entries(bundles)
    for table, transform in fhir.TRANSFORMS.items():
        expected = transform(entries)
        assert loaded[table].dtypes == expected.dtypes
        assert loaded[table].exceptAll(expected).isEmpty()
        assert expected.exceptAll(loaded[table]).isEmpty()


def test_bundle_per_file(spark, tmp_path):
    for number in range(3):
        text = json.dumps(json.loads(bundle({"resourceType": "Patient", "id": f"p{number}"})), indent=1)
        (tmp_path / f"{number}.json").write_text(text)
    entries = fhir.fhir_entries(files.fhir_bundle_scan(spark, f"{tmp_path}/*.json"))
    assert sorted(r["id"] for r in rows(entries)) == ["p0", "p1", "p2"]


def referring(url, patient="urn:uuid:aaa", visit="urn:uuid:bbb", server=""):
    entries = [
        {"fullUrl": f"{server}{patient}", "resource": {"resourceType": "Patient", "id": "p1"}},
        {"fullUrl": f"{server}{visit}", "resource": {
            "resourceType": "Encounter", "id": "e1", "subject": {"reference": patient}}},
        {"fullUrl": url, "resource": {
            "resourceType": "Condition", "id": "c1", "subject": {"reference": patient},
            "encounter": {"reference": visit}}},
        {"resource": {"resourceType": "Procedure", "id": "r1", "subject": {"reference": patient + "x"},
                      "encounter": {"reference": visit + "/_history/2"}}},
    ]
    return json.dumps({"resourceType": "Bundle", "entry": entries})


@pytest.mark.parametrize("text, visit_of_procedure", [
    (referring("urn:uuid:ccc"), "e1"),
    (referring("http://h/r4/Condition/1", "Patient/9", "Encounter/8", "http://h/r4/"), "8"),
])
def test_references_by_full_url_name_the_entry(spark, text, visit_of_procedure):
    loose = referring("urn:uuid:ccc").replace("p1", "p2").replace("aaa", "other")
    entries = fhir.fhir_entries(frame(spark, text, loose.replace("urn:uuid:other", "urn:uuid:aaa", 1)))
    conditions = rows(fhir.fhir_to_condition_occurrence(entries))
    # In the second Bundle the Patient's address is another one, so its reference stays as it is.
    assert [(r["person_id"], r["visit_occurrence_id"]) for r in conditions] == [("p1", "e1"), ("other", "e1")]
    assert [r["person_id"] for r in rows(fhir.fhir_to_visit_occurrence(entries))] == ["p1", "other"]
    first = rows(fhir.fhir_to_procedure_occurrence(entries))[0]
    assert first["visit_occurrence_id"] == visit_of_procedure and first["person_id"] != "p1"


def test_of_equal_addresses_the_first_counts(spark):
    double = json.loads(referring("urn:uuid:ccc"))
    double["entry"].insert(1, {"fullUrl": "urn:uuid:aaa", "resource": {"resourceType": "Patient", "id": "p9"}})
    entries = fhir.fhir_entries(frame(spark, json.dumps(double)), kinds=["Condition"])
    assert rows(fhir.fhir_to_condition_occurrence(entries))[0]["person_id"] == "p1"


def test_bundles_are_parsed_once_and_in_place(spark):
    entries = fhir.fhir_entries(frame(spark, referring("urn:uuid:ccc")))
    plan = fhir.fhir_to_condition_occurrence(entries)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "Exchange" not in plan


def _same_rows(left, right):
    right = right.select(left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_resources_kept_whole_give_the_same_entries(spark):
    """References by full URL, odd types, repeated keys, other kinds, text that is no Bundle."""
    texts = [
        """{"resourceType":"Bundle","entry":[
            {"fullUrl":"urn:uuid:aaa","resource":{"resourceType":"Patient","id":"p1","gender":"female","x":{"y":[1,2]}}},
            {"fullUrl":"urn:uuid:b","resource":{"resourceType":"Condition","id":"c1","subject":{"reference":"urn:uuid:aaa"},
             "code":{"coding":[{"system":"s","code":"44054006"}]}}},
            {"resource":{"resourceType":"Observation","id":"o1","valueQuantity":{"value":5.5}}}]}""",
        '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Patient","id":"p2","meta":"odd","gender":"male"}}]}',
        '{"resourceType":"Bundle","kind":"a","kind":"b","entry":[{"resource":{"resourceType":"Patient","id":"p3"}}]}',
        '{"resourceType":"Bundle","entry":[{}, null, {"resource":null}]}', '{"resourceType":"Bundle"}', "garbage", "", None,
    ]
    bundles = spark.createDataFrame([(t,) for t in texts], "value string")
    resources = fhir.fhir_resources(bundles)
    kinds = sorted((r.kind, r.id) for r in resources.collect())
    assert kinds == [("Condition", "c1"), ("Observation", "o1"), ("Patient", "p1"), ("Patient", "p2"), ("Patient", "p3")]
    for kind, table in ((k, t) for t, k in fhir.RESOURCE_OF_TABLE.items()):
        transform = fhir.TRANSFORMS[table]
        whole = transform(fhir.entries_of(resources, [kind]))
        assert _same_rows(whole, transform(fhir.fhir_entries(bundles, kinds=[kind])))
    condition = fhir.fhir_to_condition_occurrence(fhir.entries_of(resources)).first()
    assert condition.person_id == "p1"
    unlisted = resources.select(
        "id", fhir.resource_field("$.x.y[1]", "int").alias("y"),
        fhir.resource_field("$.valueQuantity.value", "double").alias("value")).where("y IS NOT NULL OR value IS NOT NULL")
    assert sorted(tuple(r) for r in unlisted.collect()) == [("o1", None, 5.5), ("p1", 2, None)]


def test_a_load_of_whole_resources_parses_text_once(spark, tmp_path):
    database = f"w_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    bundles = inputs.fhir_bundles(spark, SMALL)
    plan = fhir.fhir_resources(bundles)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") <= 2  # the Bundle, or each of its resources
    loaded = fhir.load_omop(bundles, database, whole=True)
    stored = spark.table(f"{database}.fhir_resources")
    for table, kind in fhir.RESOURCE_OF_TABLE.items():
        assert _same_rows(loaded[table], fhir.TRANSFORMS[table](fhir.fhir_entries(bundles, kinds=[kind])))
        read = fhir.entries_of(stored, [kind])._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in read and "EqualTo(kind," in read or "In(kind" in read


def test_bundles_without_the_kinds_asked_for_are_not_parsed(spark):
    plain = '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Condition","id":"c%d"}}]}'
    texts = [plain % 1, plain.replace("Condition", "Patient") % 2, plain.replace("C", "\\u0043") % 3,
             plain.replace("dition", "\\u0064ition") % 4, plain.replace('"c%d"', '"Condition"').replace(
                 '"resourceType":"Condition"', '"resourceType":"Patient"'), "no Condition", None]
    bundles = spark.createDataFrame([(text,) for text in texts], "value string")
    found = fhir.fhir_entries(bundles, kinds=["Condition"])
    assert sorted(r.id for r in found.collect()) == ["c1", "c3", "c4"]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "WHEN (Contains(value#" in text[:text.index("from_json")]
