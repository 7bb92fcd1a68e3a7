"""One callable per operator and named query: (spark, sf_dir) to DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs, tables
from wardflow import functions as fn
from wardflow.operators import ccda, fhir, hl7
from wardflow.operators.terminology import terminology_enrich
from wardflow.plans import admissions, inventory, medications, omop
from wardflow.plans.common import optional_facility_filter
from wardflow.sources import buckets, files, jdbc, landings
from wardflow.sources import tables as sinks
from wardflow.streaming import hl7_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FACILITY = inputs.FACILITIES[1]
STREAM_FILES_PER_BATCH = 1000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def no_zone(moment: Column) -> Column:
    """Timestamp as wall-clock time, so that it compares alike in any session time zone."""
    return moment.cast("timestamp_ntz")


# --- Sources and sinks ---


@query
def jdbc_scan(spark, sf_dir):
    url, driver = tables.external_table(spark, sf_dir, "supplier")
    init = "SET CURRENT ISOLATION = UR"
    return jdbc.jdbc_scan(spark, url, driver, "supplier", session_init=init)


@query
def jdbc_partitioned_scan(spark, sf_dir):
    url, driver = tables.external_table(spark, sf_dir, "orders")
    orders = jdbc.jdbc_partitioned_scan(
        spark, url, driver, "orders", "o_orderkey", num_partitions=8
    )
    return orders.withColumn("o_orderdate", no_zone(F.col("o_orderdate")))


@query
def jdbc_transfer_audited(spark, sf_dir):
    url, driver = tables.external_table(spark, sf_dir, "orders")
    target = tables.new_table(spark, sf_dir, "orders")
    audit = jdbc.jdbc_transfer_audited(
        spark, url, driver, "orders", target, partition_column="o_orderkey"
    )
    copied = spark.table(target).agg(F.count("*").alias("rows"))
    return audit.select(F.lit("audited").alias("what"), F.col("row_count").alias("rows")).unionByName(
        copied.select(F.lit("in target").alias("what"), "rows")
    )


@query
def audit_append(spark, sf_dir):
    return tables.audit_log(spark, sf_dir).select(
        "source_table",
        "row_count",
        (F.col("jdbc_source") != jdbc.NOT_CONFIGURED).alias("configured"),
    )


@query
def mask_jdbc_url(spark, sf_dir):
    key = F.col("c_custkey")
    url = F.concat(
        F.lit("jdbc:postgresql://host"), (key % 7).cast("string"),
        F.lit(":5432/clinic?user=u"), key.cast("string"),
        F.lit("&password=p"), (key * 31).cast("string"),
        F.lit("&pad="), F.repeat(F.lit("x"), (key % 60).cast("int")),
    )
    customers = inputs.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", fn.mask_jdbc_url(url).alias("masked"))


@query
def incremental_upsert(spark, sf_dir):
    target = tables.new_table(spark, sf_dir, "orders")
    orders = inputs.table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )
    early = F.year("o_orderdate") < 1999
    place = tables.new_path(spark, sf_dir, "orders")
    buckets.create_bucketed(orders.where(early), target, "o_orderkey", "o_orderdate", place, buckets=16)
    url, driver = tables.external_table(spark, sf_dir, "orders_changed")
    source = jdbc.jdbc_partitioned_scan(spark, url, driver, "orders_changed", "o_orderkey")
    place = tables.new_path(spark, sf_dir, "upsert")
    merged = jdbc.incremental_upsert(source, target, "o_orderkey", "o_orderdate", place)
    return merged.withColumn("o_orderdate", no_zone(F.col("o_orderdate")))


@query
def table_overwrite_sink(spark, sf_dir):
    target = tables.new_table(spark, sf_dir, "part")
    for _ in range(2):
        sinks.table_overwrite_sink(inputs.table(spark, sf_dir, "part"), target)
    return spark.table(target)


@query
def ctas_replace(spark, sf_dir):
    target = tables.new_table(spark, sf_dir, "segments")
    customers = inputs.table(spark, sf_dir, "customer")
    sinks.ctas_replace(spark, target, customers)
    grouped = customers.groupBy("c_mktsegment").agg(F.count("*").alias("customers"))
    return sinks.ctas_replace(spark, target, grouped)


def _document_summary() -> list[Column]:
    name = ccda.patient_name()
    return [
        F.get(ccda.patient_role()["id"], F.lit(0))["_extension"].alias("patient"),
        ccda.patient_address()["city"].alias("city"),
        F.get(name["given"], F.lit(0)).alias("first_name"),
        F.size(name["given"]).alias("given_names"),
        name["family"].alias("last_name"),
        F.size("component.structuredBody.component").alias("sections"),
    ]


@query
def xml_scan(spark, sf_dir):
    scanned = tables.scanned_documents(spark, sf_dir, SUMMARY_SCHEMA)
    return scanned.select(_document_summary())


@query
def fhir_bundle_scan(spark, sf_dir):
    landed = f"{tables.landed_bundles(spark, sf_dir)}/*"
    return files.fhir_bundle_scan(spark, landed, one_per_line=True).select(
        F.get_json_object("value", "$.entry[0].resource.id").alias("first_id"),
        F.json_array_length(F.get_json_object("value", "$.entry")).alias("entries"),
    )


@query
def hl7_file_scan(spark, sf_dir):
    scanned = files.hl7_file_scan(spark, tables.landed_messages(spark, sf_dir), framed=True)
    return scanned.select(
        hl7.hl7_field(F.col("value"), "MSH", 10).alias("message_id"),
        F.substring("value", 1, 7).alias("start_of_text"),
    )


def _plain(spark, sf_dir, name: str, texts: DataFrame) -> str:
    """Texts as ordinary files that hold many of them each."""
    path = tables.new_path(spark, sf_dir, name)
    tables.land_texts(texts, path)
    return path


@query
def hl7_file_scan_plain(spark, sf_dir):
    """All messages; text that is none is a line of the message before it, or a row without id."""
    messages = inputs.adt_messages(spark, sf_dir)
    scanned = files.hl7_file_scan(spark, _plain(spark, sf_dir, "plain-messages", messages))
    ids = scanned.select(hl7.hl7_field(F.col("value"), "MSH", 10).alias("message_id"))
    return ids.where("message_id <> ''")


@query
def xml_scan_plain(spark, sf_dir):
    path = _plain(spark, sf_dir, "plain-documents", inputs.ccda_documents(spark, sf_dir))
    return files.xml_scan(spark, path, ccda.ROW_TAG, SUMMARY_SCHEMA).select(_document_summary())


@query
def fhir_bundle_scan_plain(spark, sf_dir):
    path = _plain(spark, sf_dir, "plain-bundles", inputs.fhir_bundles(spark, sf_dir))
    return files.fhir_bundle_scan(spark, path).select(
        F.get_json_object("value", "$.entry[0].resource.id").alias("first_id"),
        F.json_array_length(F.get_json_object("value", "$.entry")).alias("entries"),
    )


@query
def fhir_parse_errors(spark, sf_dir):
    key, text = F.col("c_custkey"), F.lit('{"resourceType":"Bundle","entry":[]}')
    bundles = inputs.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 10 == 0, F.substring(text, 1, 30)).when(key % 10 == 1, "{}").otherwise(text)
        .alias("value"),
    )
    return fhir.fhir_parse_errors(bundles, keep=["c_custkey"])


@query
def provenance_columns(spark, sf_dir):
    path = tables.landed_messages(spark, sf_dir)
    traced = files.provenance_columns(files.hl7_file_scan(spark, path, framed=True))
    return traced.select(
        hl7.hl7_field(F.col("value"), "MSH", 10).alias("message_id"),
        F.col("source_file").contains(path.rsplit("/", 1)[-1]).alias("from_landing_folder"),
        F.col("parsed_at").isNotNull().alias("has_time"),
    )


@query
def landing_file_inventory(spark, sf_dir):
    path = tables.new_path(spark, sf_dir, "patients")
    inputs.patient_bundles(spark, sf_dir).write.text(path)
    total = files.landing_file_inventory(spark, path)
    listed = files.landing_file_listing(spark, path, 10)
    both = total.select("files", "bytes", F.lit(0).alias("listed")).unionByName(
        listed.select(F.lit(0).alias("files"), F.lit(0).alias("bytes"), F.lit(1).alias("listed"))
    )
    # How many files the writer made depends on the cluster, their content does not.
    return both.agg(*[F.sum(name).alias(name) for name in ("files", "bytes", "listed")]).select(
        "bytes",
        (F.col("files") > 0).alias("has_files"),
        (F.col("listed") == F.least("files", F.lit(10))).alias("listing_complete"),
    )


@query
def landing_changes(spark, sf_dir):
    """Three landings of a file of Bundles per nation, and the Bundles that each load reads."""
    folder, state = (tables.new_path(spark, sf_dir, name) for name in ("landing", "landing-state"))
    early, gone, redone = "nation < 20", "nation < 20 AND nation % 4 = 1", "nation < 20 AND nation % 4 = 0"
    rows = inputs.nation_bundles(spark, sf_dir)
    steps = [
        lambda: tables.land_by_nation(rows.where(early), folder),
        lambda: (tables.land_by_nation(rows.where(gone), folder, remove=True),
                 tables.land_by_nation(rows.where(redone).unionAll(rows.where(redone)), folder),
                 tables.land_by_nation(rows.where("nation >= 20"), folder)),
        lambda: tables.land_by_nation(rows.where(gone), folder),
    ]
    kept = tables.new_path(spark, sf_dir, "landed")
    for number, step in enumerate(steps, 1):
        step()
        landing = landings.landing_changes(spark, folder, state)
        changes = landing.changes.select(
            F.lit(number).alias("landing"), "change", tables.nation_of(F.col("path")).alias("nation"))
        for part in landings.landed_since(landing, spark.read.text):
            read = part.select(tables.nation_of(F.col("_metadata.file_name")).alias("nation"))
            counted = read.groupBy("nation").agg(F.count("*").alias("bundles"))
            changes.join(counted, "nation").write.mode("append").parquet(kept)
        vanished = changes.where("change = 'vanished'").withColumn("bundles", F.lit(0).cast("bigint"))
        vanished.select("nation", "landing", "change", "bundles").write.mode("append").parquet(kept)
        landings.commit_landing(landing)
    return spark.read.parquet(kept)


# --- HL7 jobs ---


def _messages(spark, sf_dir) -> DataFrame:
    return inputs.adt_messages(spark, sf_dir)


@query
def hl7_parse_adt(spark, sf_dir):
    return hl7.hl7_parse_adt(
        _messages(spark, sf_dir), keep=["o_orderkey"], extra=tables.MESSAGE_FIELDS
    )


@query
def hl7_field(spark, sf_dir):
    text = F.col("value")
    places = {"sending_facility": ("MSH", 4), "event_time": ("EVN", 2), "name": ("PID", 5),
              "admitted": ("PV1", 44), "diagnosis_number": ("DG1", 1), "absent": ("PV1", 60)}
    return _messages(spark, sf_dir).select(
        "o_orderkey",
        *[hl7.hl7_field(text, *place).alias(name) for name, place in places.items()],
    )


@query
def hl7_segments(spark, sf_dir):
    segments = hl7.hl7_segments(_messages(spark, sf_dir), keep=["o_orderkey"])
    return segments.select(
        "o_orderkey",
        "segment_index",
        "segment_type",
        (F.size("fields") - 1).alias("field_count"),
        F.get("fields", F.lit(3)).alias("third_field"),
    )


@query
def hl7_segment_groups(spark, sf_dir):
    segments = hl7.hl7_segments(
        inputs.lab_messages(spark, sf_dir), keep=["o_orderkey"], parents=hl7.SEGMENT_PARENTS)
    return segments.select("o_orderkey", "segment_index", "parent_index", "segment_type",
                           F.get("fields", F.lit(1)).alias("first_field"))


@query
def hl7_components(spark, sf_dir):
    parsed = hl7_parse_adt(spark, sf_dir)
    patient, kind = F.col("patient_id"), F.col("message_type")
    return parsed.select(
        "o_orderkey",
        F.size(hl7.hl7_components(patient)).alias("patient_parts"),
        hl7.hl7_component(patient, 1).alias("id_number"),
        hl7.hl7_component(patient, 4).alias("assigned_by"),
        hl7.hl7_component(kind, 2).alias("trigger_event"),
    )


@query
def hl7_event_code(spark, sf_dir):
    return hl7_parse_adt(spark, sf_dir).select(
        "o_orderkey", fn.hl7_event_code(F.col("message_type")).alias("event_code")
    )


@query
def hl7_parse_errors(spark, sf_dir):
    return hl7.hl7_parse_errors(hl7_parse_adt(spark, sf_dir))


@query
def hl7_build_adt(spark, sf_dir):
    return _messages(spark, sf_dir).select(
        "o_orderkey", F.translate("value", "\r\n", "/;").alias("message")
    )


# --- C-CDA jobs ---


#: What ``_document_summary`` reads.
SUMMARY_SCHEMA = ccda.document_schema(*[f"recordTarget.patientRole.{field}" for field in (
    "id", "addr", "patient.name")], "component.structuredBody.component.section.title")


@query
def ccda_documents(spark, sf_dir):
    texts = inputs.ccda_documents(spark, sf_dir)
    parsed = ccda.ccda_documents(texts, keep=["c_custkey"], schema=SUMMARY_SCHEMA)
    return parsed.select("c_custkey", *_document_summary())


@query
def ccda_sections(spark, sf_dir):
    parsed = ccda.ccda_documents(inputs.ccda_documents(spark, sf_dir), keep=["c_custkey"])
    return ccda.ccda_sections(parsed, keep=["c_custkey"]).select(
        "c_custkey", "title", F.size("entries").alias("entries")
    )


@query
def ccda_medications(spark, sf_dir):
    texts = inputs.ccda_documents(spark, sf_dir)
    return ccda.ccda_medications(ccda.ccda_documents(texts, schema=ccda.MEDICATION_SCHEMA))


# --- FHIR jobs ---


def _entries(spark, sf_dir, *kinds: str) -> DataFrame:
    return fhir.fhir_entries(inputs.fhir_bundles(spark, sf_dir), kinds=kinds)


@query
def fhir_entries(spark, sf_dir):
    return _entries(spark, sf_dir).select(F.col("resourceType").alias("resource_type"), "id")


@query
def fhir_to_person(spark, sf_dir):
    return fhir.fhir_to_person(_entries(spark, sf_dir, "Patient"))


@query
def fhir_to_condition_occurrence(spark, sf_dir):
    return fhir.fhir_to_condition_occurrence(_entries(spark, sf_dir, "Condition"))


@query
def fhir_to_procedure_occurrence(spark, sf_dir):
    return fhir.fhir_to_procedure_occurrence(_entries(spark, sf_dir, "Procedure"))


@query
def fhir_to_visit_occurrence(spark, sf_dir):
    visits = fhir.fhir_to_visit_occurrence(_entries(spark, sf_dir, "Encounter"))
    return visits.withColumns({
        name: no_zone(F.col(name)) for name in ("visit_start_datetime", "visit_end_datetime")
    })


@query
def condition_features(spark, sf_dir):
    conditions = fhir.fhir_to_condition_occurrence(_entries(spark, sf_dir, "Condition"))
    return fhir.condition_features(conditions)


@query
def fhir_resources(spark, sf_dir):
    """All resources kept whole; the account of an Encounter is a field that no schema names."""
    account = F.regexp_replace(
        "value", '("resourceType":"Encounter",)("id":"(e[0-9]+)")', '$1"identifier":[{"value":"V-$3"}],$2')
    # Most Bundles have no Encounter: nothing to look for.
    held = F.when(F.col("value").contains('"Encounter"'), account).otherwise(F.col("value"))
    target = tables.new_table(spark, sf_dir, "resources")
    bundles = inputs.fhir_bundles(spark, sf_dir).select(held.alias("value"))
    sinks.table_overwrite_sink(fhir.fhir_resources(bundles), target)
    return spark.table(target).select(
        F.col("kind").alias("resource_type"), "id",
        fhir.resource_field("$.identifier[0].value").alias("account"))


@query
def load_omop_whole(spark, sf_dir):
    """The conditions of a load that keeps all resources whole."""
    database = tables.database(spark, sf_dir, "fhir_whole")
    landed = f"{tables.landed_bundles(spark, sf_dir)}/*"
    bundles = files.fhir_bundle_scan(spark, landed, one_per_line=True)
    return fhir.load_omop(bundles, database, whole=True)["condition_occurrence"]


# --- Filter, preview, count ---


@query
def optional_facility_filter_query(spark, sf_dir):
    parsed = tables.parsed_hl7(spark, sf_dir).select("facility", "patient_id", "message_id")
    one = optional_facility_filter(parsed, FACILITY).select(F.lit("one").alias("scope"), "*")
    everything = optional_facility_filter(parsed, "All").select(F.lit("all").alias("scope"), "*")
    return one.unionByName(everything)


QUERIES["optional_facility_filter"] = QUERIES.pop("optional_facility_filter_query")


@query
def preview(spark, sf_dir):
    parsed = tables.parsed_hl7(spark, sf_dir)
    return sinks.preview(
        parsed.select("message_id", *hl7.PARSED_COLUMNS), 10, order_by=["message_id"]
    )


@query
def tolerant_count(spark, sf_dir):
    database = tables.database(spark, sf_dir, "hl7")
    tables.parsed_hl7(spark, sf_dir)
    there = sinks.tolerant_count(spark, f"{database}.parsed_hl7")
    not_there = sinks.tolerant_count(spark, f"{database}.no_such_table")
    return there.select(F.lit("parsed_hl7").alias("table_name"), "rows").unionByName(
        not_there.select(F.lit("no_such_table").alias("table_name"), "rows")
    )


# --- Scalar functions ---


def _codes(spark, sf_dir, values: list[str]) -> DataFrame:
    """One code per order, from a list taken round and round; NULL for every 37th."""
    key = F.col("o_orderkey")
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 37 != 0, inputs.pick(values, key)).alias("code")
    )


def _function_query(name: str, values: list[str], result: str) -> None:
    function = getattr(fn, name)

    def run(spark, sf_dir):
        return _codes(spark, sf_dir, values).select("*", function(F.col("code")).alias(result))

    QUERIES[name] = run


_function_query("snomed_description", inputs.CONDITIONS, "description")
_function_query("icd10_description", inputs.DIAGNOSES, "description")
_function_query("adt_event_description", inputs.EVENT_CODES, "description")
_function_query("hedis_measure_name", inputs.MEASURES, "description")
_function_query("is_valid_snomed", inputs.MIXED_CODES, "valid")
_function_query("is_valid_icd10", inputs.MIXED_CODES, "valid")
_function_query("code_system", inputs.MIXED_CODES, "system")


@query
def age_from_dob(spark, sf_dir):
    birth = F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") * 37 % 25000).cast("int"))
    as_of = F.lit(inputs.AS_OF).cast("date")
    return inputs.table(spark, sf_dir, "customer").select(
        "c_custkey",
        birth.alias("birth_date"),
        fn.age_from_dob(birth, as_of).alias("age"),
        fn.age_from_dob(birth, as_of, exact=True).alias("exact_age"),
    )


@query
def chronic_risk_tier(spark, sf_dir):
    key = F.col("o_orderkey")
    count = F.when(key % 11 != 0, key % 6 - 1).cast("int")
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", count.alias("conditions"), fn.chronic_risk_tier(count).alias("tier")
    )


@query
def days_overdue_bucket(spark, sf_dir):
    days = F.when(
        F.col("o_orderkey") % 19 != 0,
        F.datediff(F.lit(inputs.AS_OF).cast("date"), F.col("o_orderdate").cast("date")),
    )
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", days.alias("days"), fn.days_overdue_bucket(days).alias("bucket")
    )


@query
def register_functions(spark, sf_dir):
    database = tables.database(spark, sf_dir, "functions")
    fn.register_functions(spark, database)
    key = F.col("o_orderkey")
    coded = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        inputs.pick(inputs.CONDITIONS, key).alias("snomed"),
        inputs.pick(inputs.DIAGNOSES, key).alias("icd10"),
        inputs.pick(inputs.EVENT_CODES, key).alias("event"),
        inputs.pick(inputs.MEASURES, key).alias("measure"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    calls = {
        "snomed_text": "snomed_description(snomed)",
        "icd10_text": "icd10_description(icd10)",
        "event_text": "adt_event_description(event)",
        "measure_text": "hedis_measure_name(measure)",
        "age": f"age_from_dob(day, date'{inputs.AS_OF}')",
        "tier": "chronic_risk_tier(CAST(o_orderkey % 5 AS INT))",
        "bucket": f"days_overdue_bucket(datediff(date'{inputs.AS_OF}', day))",
        "snomed_ok": "is_valid_snomed(snomed)",
        "icd10_ok": "is_valid_icd10(icd10)",
    }
    return coded.selectExpr(
        "o_orderkey", *[f"`{database}`.{call} AS {name}" for name, call in calls.items()]
    )


@query
def validate_codes(spark, sf_dir):
    checked = fn.validate_codes(F.col("code"))
    return _codes(spark, sf_dir, inputs.MIXED_CODES).select(
        "o_orderkey", "code", checked.alias("checked")
    ).select("o_orderkey", "code", "checked.*")


@query
def terminology_enrich_query(spark, sf_dir):
    codes = _codes(spark, sf_dir, inputs.MIXED_CODES)
    measures = _codes(spark, sf_dir, inputs.MEASURES)
    return terminology_enrich(codes, "code").unionByName(
        terminology_enrich(measures, "code", "hedis")
    )


QUERIES["terminology_enrich"] = QUERIES.pop("terminology_enrich_query")


# --- Streaming ---


def _run(stream: DataFrame, spark, sf_dir, name: str, times: int = 1) -> DataFrame:
    target = tables.new_table(spark, sf_dir, name)
    checkpoint = tables.new_path(spark, sf_dir, "stream-state")
    for _ in range(times):
        hl7_stream.stream_hl7_append(stream, target, checkpoint).awaitTermination()
    return spark.table(target)


def _stream(spark, sf_dir) -> DataFrame:
    return hl7_stream.stream_hl7_source(
        spark, tables.landed_messages(spark, sf_dir),
        max_files=STREAM_FILES_PER_BATCH, framed=True,
    )


@query
def stream_hl7_source(spark, sf_dir):
    taken = _run(_stream(spark, sf_dir), spark, sf_dir, "raw_messages")
    return taken.select(
        hl7.hl7_field(F.col("value"), "MSH", 10).alias("message_id"),
        F.substring("value", 1, 7).alias("start_of_text"),
    )


@query
def stream_hl7_parse(spark, sf_dir):
    parsed = hl7_stream.stream_hl7_parse(_stream(spark, sf_dir), extra=tables.MESSAGE_FIELDS)
    appended = _run(parsed, spark, sf_dir, "streamed")
    return appended.drop("source_file", "parsed_at")


@query
def stream_hl7_append(spark, sf_dir):
    parsed = hl7_stream.stream_hl7_parse(_stream(spark, sf_dir))
    appended = _run(parsed, spark, sf_dir, "appended", times=2)
    return appended.groupBy("facility", "message_type", "admit_diagnosis").agg(
        F.count("*").alias("messages")
    )


@query
def stream_hl7_ledgered(spark, sf_dir):
    """Messages, parse errors and the counts of the ledger, after two runs."""
    place, state = (tables.new_path(spark, sf_dir, name) for name in ("ledgered", "stream-state"))
    parsed = hl7_stream.stream_hl7_parse(_stream(spark, sf_dir))
    for _ in range(2):
        hl7_stream.stream_hl7_ledgered(parsed, place, state).awaitTermination()
    counted = [
        hl7_stream.ledgered_table(spark, place, part).groupBy("facility").agg(
            F.count("*").alias("messages")).withColumn("part", F.lit(part))
        for part in ("rows", "errors")]
    ledger = hl7_stream.ledgered_table(spark, place, "ledger").agg(
        F.sum("rows").alias("rows"), F.sum("errors").alias("errors"))
    totals = ledger.select(F.lit("").alias("facility"), F.expr("rows + errors").alias("messages"),
                           F.lit("ledger").alias("part"))
    return counted[0].unionByName(counted[1]).unionByName(totals)


# --- Named queries ---


def _named(name: str, source: Callable, function: Callable, **arguments) -> None:
    QUERIES[name] = lambda spark, sf_dir: function(source(spark, sf_dir), **arguments)


def _conditions(spark, sf_dir) -> DataFrame:
    return tables.omop(spark, sf_dir)["condition_occurrence"]


def _persons(spark, sf_dir) -> DataFrame:
    return tables.omop(spark, sf_dir)["person"]


_named("q_kpi_ccda_documents", tables.documents, medications.q_kpi_ccda_documents)
_named("q_kpi_medications", tables.medications, medications.q_kpi_medications)
_named("q_kpi_omop_patients", _persons, omop.q_kpi_omop_patients)
_named("q_kpi_hl7", tables.parsed_hl7, admissions.q_kpi_hl7)


@query
def q_kpi_medications_loaded(spark, sf_dir):
    """The tile over three loads, with distinct medications from the bitmaps of the loads."""
    rows = tables.medications(spark, sf_dir)
    load = F.coalesce(F.xxhash64(*rows.columns), F.lit(0))
    store = tables.counted_loads(spark, sf_dir, rows, load, "medication_name")
    return medications.q_kpi_medications_loaded(store)


@query
def q_kpi_hl7_loaded(spark, sf_dir):
    rows = tables.parsed_hl7(spark, sf_dir)
    store = tables.counted_loads(spark, sf_dir, rows, F.xxhash64("message_id"), "facility")
    return admissions.q_kpi_hl7_loaded(store)


@query
def distinct_patients_by_facility(spark, sf_dir):
    """Messages and distinct patients per facility, over three loads."""
    rows = tables.parsed_hl7(spark, sf_dir)
    store = tables.counted_loads(
        spark, sf_dir, rows, F.xxhash64("message_id"), "patient_id", ["facility"])
    return store.counts(rows_name="messages").withColumnRenamed("patient_id", "patients")


_named("q_table_inventory", tables.inventory, inventory.q_table_inventory)
_named("q_top_medications", tables.medications, medications.q_top_medications)
_named("q_medication_frequency", tables.medications, medications.q_medication_frequency)
_named("q_medications_by_city", tables.medications, medications.q_medications_by_city)
_named("q_medication_records", tables.medications, medications.q_medication_records)
_named("q_condition_prevalence", tables.features, omop.q_condition_prevalence)
_named("q_prevalence_summary", tables.features, omop.q_prevalence_summary)
_named("q_omop_row_counts", tables.omop, omop.q_omop_row_counts)
_named("q_comorbidity_distribution", tables.features, omop.q_comorbidity_distribution)
_named("q_conditions_enriched", _conditions, omop.q_conditions_enriched)
_named("q_hl7_enriched", tables.parsed_hl7, admissions.q_hl7_enriched)
_named("q_top_diagnoses_by_facility", tables.parsed_hl7, admissions.q_top_diagnoses_by_facility)
_named("q_admissions_by_facility", tables.parsed_hl7, admissions.q_admissions_by_facility)
_named("q_messages_by_facility", tables.parsed_hl7, admissions.q_messages_by_facility)
_named("q_top_admit_diagnoses", tables.parsed_hl7, admissions.q_top_admit_diagnoses)
_named("q_top_admit_diagnoses_described", tables.parsed_hl7,
       admissions.q_top_admit_diagnoses_described, facility=FACILITY)
_named("q_diagnosis_by_facility", tables.parsed_hl7, admissions.q_diagnosis_by_facility)
_named("q_recent_messages", tables.parsed_hl7, admissions.q_recent_messages,
       newest_by=tables.NEWEST)
_named("q_recent_messages_described", tables.parsed_hl7, admissions.q_recent_messages_described,
       facility=FACILITY, newest_by=tables.NEWEST)
_named("q_facility_list", tables.parsed_hl7, admissions.q_facility_list)
_named("dq_hl7_completeness", tables.parsed_hl7, admissions.dq_hl7_completeness)
_named("dq_snomed_validity", _conditions, omop.dq_snomed_validity)
_named("dq_ccda_completeness", tables.medications, medications.dq_ccda_completeness)
_named("q_comorbid_pct", tables.features, omop.q_comorbid_pct)
_named("q_diabetes_count", tables.features, omop.q_diabetes_count)
_named("q_risk_tier_counts", tables.features, omop.q_risk_tier_counts)
_named("q_condition_codes_described", _conditions, omop.q_condition_codes_described)


@query
def q_facility_messages(spark, sf_dir):
    parsed = tables.parsed_hl7(spark, sf_dir)
    return admissions.q_facility_messages(parsed, FACILITY).drop("source_file")


@query
def q_records_per_schema(spark, sf_dir):
    listed = tables.inventory(spark, sf_dir)
    listed["audit", "jdbc_ingests"] = tables.audit_log(spark, sf_dir)
    return inventory.q_records_per_schema(listed)


@query
def q_audit_recent(spark, sf_dir):
    recent = inventory.q_audit_recent(tables.audit_log(spark, sf_dir))
    return recent.select("row_count", "source_table")


@query
def q_last_ingest(spark, sf_dir):
    return inventory.q_last_ingest(tables.audit_log(spark, sf_dir)).drop("refresh_date")
