"""Raw clinical inputs that Spark derives from the driver tables.

Every builder works row by row, or joins on keys, over the whole tables: a message per order, a
Bundle per customer, order and line, a document per customer and line. Nothing is collected per
patient or order, so a hot key makes many small inputs and no huge one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.expected import TERMINOLOGY
from wardflow.operators.hl7 import Segment, hl7_build_adt

# --- Fixed values: what the derived inputs and the oracles have in common. ---
FACILITIES = ["NORTH_GENERAL", "LAKESIDE", "ST_BRIDGET", "HARBOR_REGIONAL"]
# All labelled codes from the last to the first, one without a label, one that breaks the format.
DIAGNOSES = [*sorted(TERMINOLOGY["icd10"], reverse=True), "Z99.9", "E1199"]
SECOND_DIAGNOSIS = "J96.01"
EVENT_OF_STATUS = {"F": "A01", "O": "A02", "P": "A03"}
CONDITIONS = [
    "44054006", "427089005", "127013003", "422034002", "59621000", "55680006", "361055000",
    "449868002", "162673000", "185349003", "999999999", "ABC",
]
CLASS_OF_STATUS = {"F": "IMP", "O": "AMB", "P": "EMER"}
PROCEDURE_EVEN, PROCEDURE_ODD = "73761001", "24623002"
EVENT_CODES = [
    "A01", "A02", "A03", "A04", "A05", "A06", "A07", "A08", "A11", "A13", "A28", "A31", "A99", "",
]
MEASURES = ["AWV", "BCS", "COL", "A1C", "CBP", "PCR", "awv", "XYZ"]
MIXED_CODES = DIAGNOSES + CONDITIONS + ["A01", "A31", "A99", "12345", "i10", "", " "]
AS_OF = "2001-08-02"
# --- End of fixed values. ---

#: Messages, Bundles or documents that one task makes.
ROWS_PER_TASK = 50_000
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, driving: DataFrame, *keys: str) -> DataFrame:
    """``rows``, of which there are as many as in the table ``driving``, dealt out evenly.

    Making and parsing a text costs far more than reading its keys, and a few large row groups, or the
    partitions that a join leaves, would be as many tasks. ``keys`` tell rows apart; they move before
    the texts are made. Few rows stay where they are.
    """
    tasks = -(-driving.count() // ROWS_PER_TASK)
    return rows.repartition(tasks, *keys) if tasks > 1 else rows


def pick(values: list[str], number: Column) -> Column:
    """Element of a list by a whole number, taken round and round."""
    listed = F.array(*[F.lit(value) for value in values])
    return F.element_at(listed, (number % len(values) + 1).cast("int"))


def by_status(values: dict[str, str]) -> Column:
    status = F.col("o_orderstatus")
    result = F
    for key, value in values.items():
        result = result.when(status == key, value)
    return result


def adt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, value): one ADT message per order."""
    key = F.col("o_orderkey")
    customer = F.col("o_custkey").cast("string")
    facility = pick(FACILITIES, F.col("o_custkey"))
    first = pick(DIAGNOSES, key)
    diagnoses = (
        F.when(key % 17 == 0, F.array().cast("array<string>"))
        .when(key % 7 == 0, F.array(first, F.lit(SECOND_DIAGNOSIS)))
        .otherwise(F.array(first))
    )
    moment = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    ward = F.when(key % 5 == 0, F.concat(F.lit("WARD_"), (key % 3).cast("string")))
    nothing = F.lit("")
    orders = table(spark, sf_dir, "orders")
    built = hl7_build_adt(
        spread(orders, orders, "o_orderkey"),
        [
            Segment("MSH", {
                3: facility, 4: facility, 7: moment,
                9: [F.lit("ADT"), by_status(EVENT_OF_STATUS)],
                10: F.concat(F.lit("MSG"), key.cast("string")),
            }),
            Segment("EVN", {2: moment, 7: ward}),
            Segment("PID", {
                3: [F.concat(F.lit("PAT"), customer), nothing, nothing, facility],
                5: [F.concat(F.lit("F|"), customer), F.concat(F.lit("G&"), key.cast("string"))],
            }, when=key % 23 != 0),
            Segment("PV1", {44: F.date_format("o_orderdate", "yyyyMMdd")}),
            Segment("DG1", lambda code, place: {1: (place + 1).cast("string"), 3: code}, each=diagnoses),
        ],
        segment_end=F.when(key % 2 == 1, "\n").otherwise("\r"),
        keep=["o_orderkey"],
    )
    broken = F.concat(F.lit("garbage"), key.cast("string"))
    return built.select(
        "o_orderkey", F.when(key % 97 == 0, broken).otherwise(F.col("value")).alias("value")
    )


def _bundle(*resources: Column, addresses: tuple[Column, ...] = ()) -> Column:
    """A Bundle of resources; ``addresses`` are the full URLs of the first ones."""
    urls = [*addresses, *[F.lit(None).cast("string")] * (len(resources) - len(addresses))]
    entries = F.array(*[F.struct(url.alias("fullUrl"), r.alias("resource"))
                        for url, r in zip(urls, resources)])
    return F.to_json(
        F.struct(
            F.lit("Bundle").alias("resourceType"),
            F.lit("collection").alias("type"),
            entries.alias("entry"),
        )
    )


def _resource(kind: str, **fields: Column) -> Column:
    """A resource with the fields of all kinds; those it lacks are NULL and not written."""
    concept = "struct<coding:array<struct<system:string,code:string>>>"
    types = {
        "id": "string", "gender": "string", "birthDate": "string", "code": concept,
        "class": "struct<code:string>", "subject": "struct<reference:string>",
        "encounter": "struct<reference:string>", "period": "struct<start:string,end:string>",
        "onsetDateTime": "string", "performedDateTime": "string",
    }
    columns = [
        fields.get(name, F.lit(None)).cast(kind_of).alias(name) for name, kind_of in types.items()
    ]
    return F.struct(F.lit(kind).alias("resourceType"), *columns)


def _patient(key: Column) -> Column:
    born = F.date_add(F.lit("1940-01-01").cast("date"), (key * 37 % 25000).cast("int"))
    return _resource(
        "Patient",
        id=F.concat(F.lit("p"), key.cast("string")),
        gender=F.when(key % 2 == 0, "male").otherwise("female"),
        birthDate=born.cast("string"),
    )


def _snomed(code: Column) -> Column:
    coding = F.struct(F.lit("http://snomed.info/sct").alias("system"), code.alias("code"))
    return F.struct(F.array(coding).alias("coding"))


def _reference(text: Column) -> Column:
    return F.struct(text.alias("reference"))


def _subject(order_key: Column, customer_key: Column) -> Column:
    form = F.when(order_key % 2 == 0, "urn:uuid:p").otherwise("Patient/p")
    return F.concat(form, customer_key.cast("string"))


def _address(kind: str, key: Column) -> Column:
    """A full URL that doesn't tell the id of the resource."""
    return F.concat(F.lit("urn:uuid:"), F.md5(F.concat(F.lit(kind), key.cast("string"))))


def _instant(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def patient_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): a Bundle with the Patient per customer."""
    customers = table(spark, sf_dir, "customer")
    return spread(customers, customers, "c_custkey").select(
        _bundle(_patient(F.col("c_custkey"))).alias("value")
    )


def fhir_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): a Bundle with the Patient per customer, one with Patient, Encounter and Condition
    per order, one with the Procedure per order line.

    Every third order's Bundle refers to Patient and Encounter by full URLs unlike their ids, every
    fifth one's by an address on a server; the others refer by id."""
    customer_key, order_key = F.col("o_custkey"), F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    subject = _subject(order_key, customer_key)
    server = F.lit("https://fhir.example.org/r4/")
    by_url, by_server = order_key % 3 == 0, order_key % 5 == 0
    patient_url = F.when(by_url, _address("p", customer_key)).when(
        by_server, F.concat(server, F.lit("Patient/x"), customer_key.cast("string")))
    encounter_url = F.when(by_url, _address("e", order_key)).when(
        by_server, F.concat(server, F.lit("Encounter/x"), order_key.cast("string")))
    in_bundle = F.when(by_url, patient_url).when(
        by_server, F.concat(F.lit("Patient/x"), customer_key.cast("string"))).otherwise(subject)
    encounter_id = F.concat(F.lit("e"), order_key.cast("string"))
    ended = F.timestamp_add("DAY", (order_key % 9).cast("int"), F.col("o_orderdate"))
    encounter = _resource(
        "Encounter",
        id=encounter_id,
        subject=_reference(in_bundle),
        **{"class": F.struct(by_status(CLASS_OF_STATUS).alias("code"))},
        period=F.struct(_instant(F.col("o_orderdate")).alias("start"), _instant(ended).alias("end")),
    )
    condition = _resource(
        "Condition",
        id=F.concat(F.lit("c"), order_key.cast("string")),
        subject=_reference(F.when(by_url, patient_url).otherwise(subject)),
        encounter=_reference(F.when(by_url | by_server, encounter_url).otherwise(
            F.concat(F.lit("Encounter/"), encounter_id))),
        code=_snomed(pick(CONDITIONS, order_key)),
        onsetDateTime=_instant(F.col("o_orderdate")),
    )
    procedure = _resource(
        "Procedure",
        id=F.concat_ws("-", *[
            F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")
        ]),
        subject=_reference(subject),
        encounter=_reference(F.concat(F.lit("urn:uuid:"), encounter_id)),
        code=_snomed(F.when(F.col("l_partkey") % 2 == 0, PROCEDURE_EVEN).otherwise(PROCEDURE_ODD)),
        performedDateTime=_instant(F.col("l_shipdate")),
    )
    lineitem = table(spark, sf_dir, "lineitem")
    lines = spread(
        lineitem.select(*LINE, "l_shipdate")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == order_key)
        .select(*LINE, "l_shipdate", "o_custkey"),
        lineitem, *LINE).withColumn("o_orderkey", F.col("l_orderkey"))
    of_orders = spread(orders, orders, "o_orderkey").select(_bundle(
        _patient(customer_key), encounter, condition, addresses=(patient_url, encounter_url)
    ).alias("value"))
    of_lines = lines.select(_bundle(procedure).alias("value"))
    return patient_bundles(spark, sf_dir).unionByName(of_orders).unionByName(of_lines)


def xml_text(text: Column) -> Column:
    """Text with the characters that XML reserves written as entities."""
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def _element(name: str, *content: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), *content, F.lit(f"</{name}>"))


def _medication_entry(name: Column) -> Column:
    shown = F.coalesce(F.concat(F.lit(' displayName="'), xml_text(name), F.lit('"')), F.lit(""))
    code = F.concat(F.lit('<code code="1"'), shown, F.lit("/>"))
    for tag in (
        "manufacturedMaterial", "manufacturedProduct", "consumable", "substanceAdministration",
        "entry",
    ):
        code = _element(tag, code)
    return code


def _section(title: str, *entries: Column) -> Column:
    titled = F.lit(f"<title>{title}</title>")
    return _element("component", _element("section", titled, *entries))


def ccda_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, value): a document without medications per customer, and one per order line
    with the line's part as medication, written twice for even parts."""
    key = F.col("c_custkey")
    number = key.cast("string")
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    city = F.when(key % 41 != 0, _element("city", xml_text(F.col("n_name"))))
    second = F.when(key % 6 == 0, "<given>X</given>").otherwise("")
    given = F.concat(_element("given", F.lit("G"), (key % 50).cast("string")), second)
    family = _element("family", F.lit("F"), (key % 200).cast("string"))
    header = _element(
        "recordTarget",
        _element(
            "patientRole",
            F.concat(F.lit('<id extension="p'), number, F.lit('"/>')),
            _element("addr", F.coalesce(city, F.lit(""))),
            _element("patient", _element("name", given, family)),
        ),
    )
    allergies = _section("Allergies", _medication_entry(F.lit("Not a medication")))
    entry = _medication_entry(F.col("medication"))
    again = F.when(F.col("twice"), entry).otherwise("")
    medications = F.when(key % 13 != 0, _section("Medications", entry, again)).otherwise("")

    def document(*sections: Column) -> Column:
        root = F.lit('<ClinicalDocument xmlns="urn:hl7-org:v3"><title>Summary</title>')
        body = _element("component", _element("structuredBody", *sections))
        return F.concat(root, header, body, F.lit("</ClinicalDocument>")).alias("value")

    lineitem = table(spark, sf_dir, "lineitem")
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(
        customers.select("c_custkey", "n_name"), F.col("o_custkey") == key)
    part_key = F.col("p_partkey")
    name = F.when(part_key % 29 != 0, F.concat_ws(" ", "p_type", "p_name"))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", name.alias("medication"), (part_key % 2 == 0).alias("twice"))
    # The texts of the part come last, so that the other joins move keys only. Lines are dealt out by
    # a hash in place of their keys, and with what the documents show.
    lines = spread(
        lineitem.select(LINE)
        .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == part_key)
        .select(F.hash(*LINE).alias("line"), "c_custkey", "n_name", "medication", "twice"),
        lineitem, "line")
    apart = spread(customers, table(spark, sf_dir, "customer"), "c_custkey")
    return apart.select("c_custkey", document(allergies)).unionByName(
        lines.select("c_custkey", document(allergies, medications))
    )


def lab_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, value): one result message per order, of one to four repeated groups.

    Group g has an ORC, an OBR and one to three OBX; every second one ends with a note.
    """
    key = F.col("o_orderkey")

    def group(g: Column) -> Column:
        number = g.cast("string")
        results = F.transform(F.sequence(F.lit(1).cast("bigint"), (key + g) % 3 + 1), lambda j: F.concat(
            F.lit("OBX|"), j.cast("string"), F.lit("|NM|718-7||"), (key % 20).cast("string")))
        note = F.when(g % 2 == 0, F.lit("\rNTE|1||checked")).otherwise("")
        return F.concat(F.lit("ORC|"), number, F.lit("\rOBR|"), number, F.lit("||X\r"),
                        F.array_join(results, "\r"), note)

    groups = F.transform(F.sequence(F.lit(1).cast("bigint"), key % 4 + 1), group)
    head = F.concat(F.lit("MSH|^~\\&|LAB|L|||20010101||ORU^R01|R"), key.cast("string"),
                    F.lit("|P|2.5\rPID|1||PAT"), F.col("o_custkey").cast("string"), F.lit("\r"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(head, F.array_join(groups, "\r")).alias("value"))


def nation_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation, value): a Bundle with the Patient per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("int").alias("nation"), _bundle(_patient(F.col("c_custkey"))).alias("value"))
