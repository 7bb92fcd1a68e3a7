"""HL7 parsing: edge rows, random messages against a plain parser, round trips, file forms."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import plain_hl7
from tests.conftest import SMALL
from checks import inputs
from wardflow.operators import hl7
from wardflow.sources import files

HEAD = "MSH|^~\\&|FAC|FAC|R|R|20200101||ADT^A01|M1|P|2.5"
EDGES = [
    None,
    "",
    "   ",
    "garbage",
    "MSH",
    "MSH|^~\\&|FAC|FAC|R|R|20200101",
    HEAD,
    HEAD + "\rPID|1||P1^^^FAC\rDG1|1|ICD10|I10",
    HEAD + "\nEVN|A01|2020\nPID|1||P1\n",
    HEAD + "\r\nEVN|A01|2020|||||WARD\r\nPID|1||P1~P2\r\nDG1|1|ICD10|I10\r\n",
    HEAD + "\rEVN|A01|2020|||||\rDG1|1|ICD10|I10\rDG1|2|ICD10|J18.9",
    HEAD + "\rDG1|1\rDG1|2|ICD10|J18.9",
    HEAD + "\rOBX|1|TX|XPID|1||NOT^ME\rPID|1||P1",
    HEAD + "\rXPID|1||NO\rPIDX|1||NO\rPID",
    "\r\n " + HEAD + "\rPID|1||P1  \r\r",
    "PID|1||P1\r" + HEAD,
    "MSH#^~\\&#F|1#FAC#R#R#2020##ADT^A01#M1#P#2.5\rPID#1##P|1^^^F\rDG1#1#ICD10#I|10",
    "MSH$^~\\&$F$FAC$R$R$2020$$ADT^A01$M1\rPID$1$$P.1\rEVN$A01$2020$$$$$W",
    "MSH|^~\\&|||||||ADT^A01",
]


def parsed(spark, texts):
    rows = [(place, text) for place, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "place int, value string")
    result = hl7.hl7_parse_adt(frame, keep=["place"]).orderBy("place").collect()
    return [{k: x for k, x in row.asDict().items() if k != "place"} for row in result]


def test_edges_match_the_contract(spark):
    assert parsed(spark, EDGES) == [plain_hl7.parse(text) for text in EDGES]


def test_edges_by_hand(spark):
    rows = parsed(spark, EDGES)
    assert rows[0]["facility"] == "PARSE_ERROR: no message text" and rows[0]["patient_id"] == ""
    assert rows[3]["facility"] == "PARSE_ERROR: first segment is not MSH"
    assert rows[5]["is_parse_error"] and rows[5]["message_type"] == ""
    assert rows[7]["admit_location"] == "FAC" and rows[7]["patient_id"] == "P1^^^FAC"
    assert rows[9]["admit_location"] == "WARD" and rows[9]["patient_id"] == "P1~P2"
    assert rows[10]["admit_location"] == "FAC" and rows[10]["admit_diagnosis"] == "I10"
    assert rows[11]["admit_diagnosis"] == ""
    assert rows[12]["patient_id"] == "P1"
    assert rows[16]["patient_id"] == "P|1^^^F" and rows[16]["facility"] == "F|1"
    assert rows[18]["message_type"] == "ADT^A01" and not rows[18]["is_parse_error"]


pieces = st.text(alphabet="A1^~ |\\#PIDMSH", max_size=6)
segments = st.builds(
    lambda name, fields: "|".join([name, *fields]),
    st.sampled_from(["PID", "EVN", "DG1", "PV1", "MSH", "XPID", "PIDX", ""]),
    st.lists(pieces, max_size=9),
)
messages = st.builds(
    lambda start, sep, head, body, end: start + end.join(
        ["MSH" + sep + sep.join(head)] + [line.replace("|", sep) for line in body]
    ),
    st.sampled_from(["", "\r\n", "x"]),
    st.sampled_from(["|", "|", "|", "#", "$", "."]),
    st.lists(pieces, max_size=11),
    st.lists(segments, max_size=5),
    st.sampled_from(["\r", "\n", "\r\n"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(messages, min_size=30, max_size=60))
def test_random_messages_match_the_contract(spark, texts):
    assert parsed(spark, texts) == [plain_hl7.parse(text) for text in texts]


def test_build_then_parse_gives_the_columns_back(spark):
    rows = [("P1", "A", ["I10", "J18.9"], "W|1^~\\&"), (None, "B", [], None), ("P3", "C", ["E11.9"], "")]
    frame = spark.createDataFrame(rows, "pid string, fac string, dx array<string>, loc string")
    built = hl7.hl7_build_adt(
        frame,
        [
            hl7.Segment("MSH", {3: F.col("fac"), 9: [F.lit("ADT"), F.lit("A01")]}),
            hl7.Segment("EVN", {7: F.col("loc")}),
            hl7.Segment("PID", {3: [F.col("pid"), F.lit("x^y")]}, when=F.col("pid").isNotNull()),
            hl7.Segment("DG1", lambda code, place: {1: place.cast("string"), 3: code}, each=F.col("dx")),
        ],
        keep=["fac"],
    )
    renamed = built.withColumnRenamed("fac", "f")
    parsed = hl7.hl7_parse_adt(renamed, keep=["f"]).withColumn(
        "place", hl7.hl7_unescaped(F.col("admit_location")))
    found = {row["f"]: row for row in parsed.collect()}
    assert found["A"]["patient_id"] == "P1^x\\S\\y" and found["A"]["admit_diagnosis"] == "I10"
    assert found["A"]["place"] == "W|1^~\\&" and found["C"]["admit_location"] == "C"
    assert found["B"]["patient_id"] == "" and found["B"]["admit_diagnosis"] == ""
    assert found["A"]["message_type"] == "ADT^A01"


def test_escapes_go_both_ways(column):
    texts = ["a|b^c~d&e\\f", "\\F\\", "x\r\ny", "", None]
    there = column(texts, "string", hl7.hl7_escaped)
    assert not any(sign in (text or "") for text in there for sign in "|^~&\r\n")
    assert column(texts, "string", lambda c: hl7.hl7_unescaped(hl7.hl7_escaped(c))) == texts


def test_signs_of_the_message_itself(column):
    given_, kind = ["ADT$A01", "ADT^A01", "", None], "string"
    own = F.lit("$~\\&")
    assert column(given_, kind, lambda c: hl7.hl7_component(c, 2, own)) == ["A01", None, None, None]
    assert column(["a~b", "a"], kind, hl7.hl7_repetitions) == [["a", "b"], ["a"]]
    assert column(["a&b", "a"], kind, hl7.hl7_subcomponents) == [["a", "b"], ["a"]]
    assert column(["a#b"], kind, lambda c: hl7.hl7_repetitions(c, F.lit("^#"))) == [["a", "b"]]


def test_field_equals_the_parse(spark):
    """The search in the text and the cut of the whole text give the same fields."""
    frame = inputs.adt_messages(spark, SMALL)
    places = {"a": ("PID", 3), "b": ("DG1", 3), "c": ("EVN", 7), "d": ("PV1", 44), "e": ("PV1", 60)}
    whole = hl7.hl7_parse_adt(frame, keep=["o_orderkey"], extra=places)
    fields = [hl7.hl7_field(F.col("value"), *p).alias(f"f_{n}") for n, p in places.items()]
    both = whole.join(frame.select("o_orderkey", *fields), "o_orderkey")
    assert both.count() and both.where(" OR ".join(f"{n} <> f_{n}" for n in places)).count() == 0


def test_segments_number_fields_as_the_standard_does(spark):
    text = "MSH#^~\\&#F|1#FAC\rPID#1##P1\r\rDG1#1"
    frame = spark.createDataFrame([(text,), ("garbage",), (None,)], "value string")
    rows = hl7.hl7_segments(frame).orderBy("segment_index").collect()
    assert [(r.segment_index, r.segment_type) for r in rows] == [(0, "MSH"), (1, "PID"), (2, "DG1")]
    assert rows[0].fields == ["MSH", "#", "^~\\&", "F|1", "FAC"]
    assert rows[1].fields[3] == "P1"


def test_field_of_null_and_of_the_separator(column):
    texts = [HEAD, "MSH#^~\\&#F", "garbage", None]
    assert column(texts, "string", lambda c: hl7.hl7_field(c, "MSH", 1)) == ["|", "#", "", None]
    assert column(texts, "string", lambda c: hl7.hl7_field(c, "MSH", 3)) == ["FAC", "F", "", None]


def test_components(column):
    given_, kind = ["PAT1^^^FAC", "X", "", None], "string"
    assert column(given_, kind, lambda c: hl7.hl7_component(c, 1)) == ["PAT1", "X", "", None]
    assert column(given_, kind, lambda c: hl7.hl7_component(c, 4)) == ["FAC", None, None, None]


def test_one_message_per_file_and_framed_files_read_alike(spark, tmp_path):
    messages = inputs.adt_messages(spark, SMALL).limit(60).cache()
    single, framed = f"{tmp_path}/single", f"{tmp_path}/framed"
    messages.select("value").coalesce(1).write.option("maxRecordsPerFile", 1).text(single)
    files.write_framed_messages(messages, framed, messages_per_file=7)
    expected = sorted(map(repr, hl7.hl7_parse_adt(messages).collect()))
    for scan in (files.hl7_file_scan(spark, single), files.hl7_file_scan(spark, framed, True)):
        traced = files.provenance_columns(scan)
        assert traced.where("source_file is null or parsed_at is null").count() == 0
        assert sorted(map(repr, hl7.hl7_parse_adt(traced).collect())) == expected


def test_parse_error_rows_are_listed(spark):
    frame = spark.createDataFrame([(HEAD,), ("x",), (None,)], "value string")
    errors = hl7.hl7_parse_errors(hl7.hl7_parse_adt(frame)).collect()
    assert len(errors) == 2 and all(row.facility.startswith("PARSE_ERROR: ") for row in errors)


def test_segments_find_the_segment_they_belong_to(spark):
    result = ("MSH|^~\\&|LAB\rPID|1\rNTE|1\rORC|1\rOBR|1\rOBX|1\rNTE|1\rNTE|2\rOBX|2\r"
              "ORC|2\rOBR|2\rNTE|1\rZZZ|1\rOBX|1")
    other = "MSH#^~\\&#LAB\nOBX#1\nPID#1\nOBX#2"
    rows = [(1, result), (2, other), (3, "no message"), (4, None), (5, "MSH|"), (5, "MSH|")]
    messages = spark.createDataFrame(rows, "n int, value string")
    found = hl7.hl7_segments(messages, keep=["n"], parents=hl7.SEGMENT_PARENTS)
    places = {}
    for row in found.orderBy("n", "segment_index").collect():
        places.setdefault(row.n, []).append(row.parent_index)
    assert places == {1: [None, None, 1, 1, 3, 4, 5, 5, 4, 1, 9, 10, None, 10],
                      2: [None, None, None, 2], 5: [None, None]}
    plain = hl7.hl7_segments(messages, keep=["n"])
    assert found.drop("parent_index").exceptAll(plain).isEmpty() and found.count() == plain.count()
    nothing = hl7.hl7_segments(messages, parents={})
    assert nothing.where("parent_index IS NOT NULL").isEmpty() and nothing.count() == plain.count()


def test_segment_parents_are_found_within_the_row(spark):
    messages = spark.createDataFrame([("MSH|a",)], "value string")
    found = hl7.hl7_segments(messages, parents=hl7.SEGMENT_PARENTS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Generate") == 1
