"""FHIR R4 Bundles to four OMOP-style tables and the chronic-condition flags.

Bundles are parsed with explicit schemas that hold only the fields in use, so nothing is inferred
and the rest of the JSON is skipped by the parser.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from wardflow.functions import vocabulary as v
from wardflow.sources.tables import table_overwrite_sink

# --- Fixed values: names and places in the FHIR standard. ---
SNOMED_SYSTEM = "http://snomed.info/sct"
RESOURCE_OF_TABLE = {
    "person": "Patient",
    "condition_occurrence": "Condition",
    "procedure_occurrence": "Procedure",
    "visit_occurrence": "Encounter",
}
REFERRING = ("subject", "encounter")
REFERENCED_KINDS = ("Patient", "Encounter")
# --- End of fixed values. ---


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT = StringType()
_CONCEPT = _struct(coding=ArrayType(_struct(system=_TEXT, code=_TEXT)))
_REFERENCE = _struct(reference=_TEXT)
_PERIOD = _struct(start=_TEXT, end=_TEXT)

# Fields read of each resource kind.
RESOURCE_FIELDS = {
    "Patient": {
        "gender": _TEXT, "birthDate": _TEXT, "meta": _struct(lastUpdated=_TEXT),
    },
    "Condition": {
        "code": _CONCEPT, "subject": _REFERENCE, "encounter": _REFERENCE,
        "onsetDateTime": _TEXT, "recordedDate": _TEXT,
    },
    "Procedure": {
        "code": _CONCEPT, "subject": _REFERENCE, "encounter": _REFERENCE,
        "performedDateTime": _TEXT, "performedPeriod": _PERIOD,
    },
    "Encounter": {"class": _struct(code=_TEXT), "subject": _REFERENCE, "period": _PERIOD},
}


def resource_schema(kinds: Sequence[str] | None = None) -> StructType:
    """Fields of the given resource kinds side by side."""
    fields = {"resourceType": _TEXT, "id": _TEXT}
    for kind in kinds or RESOURCE_FIELDS:
        fields.update(RESOURCE_FIELDS[kind])
    return _struct(**fields)


def fhir_entries(
    bundles: DataFrame, col: str = "value", kinds: Sequence[str] | None = None
) -> DataFrame:
    """One row per Bundle entry, with the fields of the resource kinds asked for.

    Other kinds are left out. Text that is no Bundle has no entries; ``fhir_parse_errors`` lists it.
    References to an entry of the same Bundle by its ``fullUrl`` become ``Kind/id`` of that entry.
    This happens within the row: only entries whose id is not already the end of their address are
    kept as targets, and of those only the kinds that are referenced. Of several entries with one
    address the first counts; a reference without such an entry stays as it is. Of Bundles without
    an entry of the kinds asked for the JSON is searched, but not parsed.
    """
    kinds = list(kinds or RESOURCE_FIELDS)
    schema = resource_schema(kinds)
    bundle = _struct(entry=ArrayType(_struct(fullUrl=_TEXT, resource=schema)))
    def beside_targets(entries: Column) -> Column:
        return _let(_targets(entries), lambda targets: F.transform(entries, lambda entry: F.struct(
            entry["fullUrl"].alias("url"), entry["resource"].alias("resource"),
            targets.alias("targets"))))

    # A text that can't hold any of the kinds is not parsed.
    parsed = F.when(_may_hold(F.col(col), kinds), F.from_json(F.col(col), bundle)["entry"])
    each = bundles.select(F.explode(_let(parsed, beside_targets)).alias("entry")).where(
        F.col("entry.resource.resourceType").isin(kinds))
    return each.select(*[
        _resolved(F.col(f"entry.resource.{name}"), F.col("entry.url"), F.col("entry.targets")).alias(name)
        if name in REFERRING else F.col(f"entry.resource.{name}") for name in schema.names
    ])


def _may_hold(text: Column, kinds: Sequence[str]) -> Column:
    """Whether a JSON text can hold one of the kinds: its letters as they are, or some as ``\\u0050``."""
    return reduce(lambda a, b: a | b, [text.contains(sign) for sign in (*kinds, "\\u")])


def _let(value: Column, use) -> Column:
    """``use`` of a value computed once per row; a column that a lambda reads would be inlined."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _targets(entries: Column) -> Column:
    """Address and ``Kind/id`` of the entries whose id can't be told from their address."""
    def named(entry: Column) -> Column:
        resource = entry["resource"]
        return F.struct(entry["fullUrl"].alias("url"), F.concat(
            resource["resourceType"], F.lit("/"), resource["id"]).alias("name"))

    def wanted(entry: Column) -> Column:
        resource = entry["resource"]
        return resource["resourceType"].isin(*REFERENCED_KINDS) & (
            _referenced_id(entry["fullUrl"]) != resource["id"])

    return F.coalesce(F.transform(F.filter(entries, wanted), named),
                      F.array().cast("array<struct<url:string,name:string>>"))


def _resolved(reference: Column, referring: Column, targets: Column) -> Column:
    """A reference struct whose text is ``Kind/id`` where the Bundle has an entry of that address.

    A relative reference is completed by the address of the entry that holds it.
    """
    text = F.substring_index(reference["reference"], "/_history/", 1)
    base = F.regexp_extract(referring, "^(https?://.*/)[^/]+/[^/]+$", 1)
    whole = F.when(text.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), text).otherwise(F.concat(base, text))
    found = F.get(F.filter(targets, lambda target: target["url"] == whole), F.lit(0))["name"]
    return F.when((F.size(targets) > 0) & found.isNotNull(), F.struct(found.alias("reference"))
                  ).otherwise(reference)


def fhir_resources(bundles: DataFrame, col: str = "value") -> DataFrame:
    """One row per Bundle entry with its resource whole: ``kind, id, url, targets, resource``.

    ``resource`` is a VARIANT: any field can be read by ``resource_field`` later, also one that no
    schema here names, without parsing text again. ``entries_of`` gives the rows of
    ``fhir_entries``. A Bundle is parsed once. One that is no VARIANT as a whole, because it is too
    large for that or a key is repeated in an object, is cut into resources first, and each is parsed
    by itself; a resource that isn't one even so has a row with NULL as ``resource``.
    """
    text = F.col(col)
    whole = F.try_variant_get(F.try_parse_json(text), "$.entry", "array<struct<fullUrl:string,resource:variant>>")
    cut = _let(F.from_json(text, "entry array<struct<fullUrl:string,resource:string>>")["entry"], _each_parsed)
    entries = F.coalesce(_let(whole, _each_named), cut)

    def beside_targets(named: Column) -> Column:
        return _let(_targets(named), lambda targets: F.transform(named, lambda entry: F.struct(
            entry["resource"]["resourceType"].alias("kind"), entry["resource"]["id"].alias("id"),
            entry["fullUrl"].alias("url"), targets.alias("targets"), entry["whole"].alias("resource"))))

    each = bundles.select(F.explode(_let(entries, beside_targets)).alias("entry"))
    return each.where("entry.kind IS NOT NULL").select("entry.*")


def _named(url: Column, kind: Column, identifier: Column, resource: Column) -> Column:
    return F.struct(url.alias("fullUrl"), F.struct(
        kind.alias("resourceType"), identifier.alias("id")).alias("resource"), resource.alias("whole"))


def _each_named(entries: Column) -> Column:
    return F.transform(entries, lambda entry: _named(
        entry["fullUrl"], resource_field("$.resourceType", "string", entry["resource"]),
        resource_field("$.id", "string", entry["resource"]), entry["resource"]))


def _each_parsed(entries: Column) -> Column:
    def parsed(entry: Column) -> Column:
        text = entry["resource"]
        return _named(entry["fullUrl"], F.get_json_object(text, "$.resourceType"),
                      F.get_json_object(text, "$.id"), F.try_parse_json(text))

    return F.transform(entries, parsed)


def resource_field(path: str, kind: str = "string", resource: Column | None = None) -> Column:
    """A field of a stored resource by its path (``$.identifier[0].value``); NULL if it isn't there."""
    return F.try_variant_get(F.col("resource") if resource is None else resource, path, kind)


def entries_of(resources: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``fhir_entries`` from the rows of ``fhir_resources``, references resolved."""
    kinds = list(kinds or RESOURCE_FIELDS)
    schema = resource_schema(kinds)
    typed = resources.where(F.col("kind").isin(kinds)).select(
        "kind", "id", "url", "targets", resource_field("$", schema.simpleString()).alias("fields"))
    given = {"resourceType": F.col("kind"), "id": F.col("id")}
    return typed.select(*[
        given[name].alias(name) if name in given else
        _resolved(F.col(f"fields.{name}"), F.col("url"), F.col("targets")).alias(name)
        if name in REFERRING else F.col(f"fields.{name}") for name in schema.names
    ])


def fhir_parse_errors(bundles: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The Bundles ``fhir_entries`` gets nothing from by fault: cause, and the start of the text.

    That is text which is no JSON (a truncated file, for instance), and JSON that is no Bundle.
    """
    text = F.col(col)
    kind = F.get_json_object(text, "$.resourceType")
    cause = (
        F.when(text.isNull() | ~text.rlike(r"\S"), "no text")
        .when(F.try_parse_json(text).isNull(), "not JSON")
        .when(~kind.eqNullSafe(F.lit("Bundle")), "not a Bundle")
    )
    told = bundles.select(*keep, cause.alias("cause"), F.substring(text, 1, 100).alias("start_of_text"))
    return told.where("cause IS NOT NULL")


def _of_kind(entries: DataFrame, kind: str) -> DataFrame:
    return entries.where(F.col("resourceType") == kind)


def _referenced_id(reference: Column) -> Column:
    """``Patient/x``, ``urn:uuid:x``, a full address or one with a version, to ``x``."""
    unversioned = F.substring_index(reference, "/_history/", 1)
    tail = F.substring_index(F.substring_index(unversioned, "/", -1), ":", -1)
    return F.nullif(tail, F.lit(""))


def _source_code(concept: Column) -> Column:
    """Code of the first SNOMED coding, else of the first coding."""
    codings = concept["coding"]
    snomed = F.filter(codings, lambda c: c["system"] == SNOMED_SYSTEM)
    return F.coalesce(F.get(snomed, F.lit(0))["code"], F.get(codings, F.lit(0))["code"])


def _day(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date")


def _birth_part(text: Column, start: int, length: int) -> Column:
    """Year, month or day of a birth date that may stop after any of them."""
    part = F.substring(text, start, length)
    return F.when(part.rlike(rf"^[0-9]{{{length}}}$"), part.try_cast("int"))


def fhir_to_person(entries: DataFrame) -> DataFrame:
    """Patients, one row per id.

    Of several copies of a Patient the one updated last counts. Copies meet in a partial
    aggregate before the shuffle, so a patient who comes with every Bundle is no hot spot.
    """
    newest = (
        _of_kind(entries, "Patient")
        .where(F.col("id").isNotNull())
        .groupBy(F.col("id").alias("person_id"))
        .agg(F.max(F.struct(F.col("meta.lastUpdated").alias("updated"), "birthDate", "gender"))
             .alias("patient"))
    )
    birth = F.col("patient.birthDate")
    return newest.select(
        "person_id",
        F.col("patient.gender").alias("gender_source_value"),
        _birth_part(birth, 1, 4).alias("year_of_birth"),
        _birth_part(birth, 6, 2).alias("month_of_birth"),
        _birth_part(birth, 9, 2).alias("day_of_birth"),
        F.when(F.length(birth) >= 10, _day(birth)).alias("birth_datetime"),
    )


def fhir_to_condition_occurrence(entries: DataFrame) -> DataFrame:
    return _of_kind(entries, "Condition").select(
        F.col("id").alias("condition_occurrence_id"),
        _referenced_id(F.col("subject.reference")).alias("person_id"),
        _referenced_id(F.col("encounter.reference")).alias("visit_occurrence_id"),
        _source_code(F.col("code")).alias("condition_source_value"),
        _day(F.coalesce("onsetDateTime", "recordedDate")).alias("condition_start_date"),
    )


def fhir_to_procedure_occurrence(entries: DataFrame) -> DataFrame:
    return _of_kind(entries, "Procedure").select(
        F.col("id").alias("procedure_occurrence_id"),
        _referenced_id(F.col("subject.reference")).alias("person_id"),
        _referenced_id(F.col("encounter.reference")).alias("visit_occurrence_id"),
        _source_code(F.col("code")).alias("procedure_source_value"),
        _day(F.coalesce("performedDateTime", "performedPeriod.start")).alias("procedure_date"),
    )


def fhir_to_visit_occurrence(entries: DataFrame) -> DataFrame:
    return _of_kind(entries, "Encounter").select(
        F.col("id").alias("visit_occurrence_id"),
        _referenced_id(F.col("subject.reference")).alias("person_id"),
        F.col("class.code").alias("visit_source_value"),
        F.col("period.start").try_cast("timestamp").alias("visit_start_datetime"),
        F.col("period.end").try_cast("timestamp").alias("visit_end_datetime"),
    )


TRANSFORMS = {
    "person": fhir_to_person,
    "condition_occurrence": fhir_to_condition_occurrence,
    "procedure_occurrence": fhir_to_procedure_occurrence,
    "visit_occurrence": fhir_to_visit_occurrence,
}


def load_omop(
    bundles: DataFrame, database: str, col: str = "value", whole: bool = False
) -> dict[str, DataFrame]:
    """Write the four tables to ``database`` and return them.

    The JSON is parsed once, into ``fhir_resources``. Each task sorts its rows by resource kind
    and writes one file, without a shuffle; each table then reads its own columns and, by the
    page statistics, the pages of its kind. With ``whole`` that table holds all resources, of every
    kind and with all their fields, in the form of ``fhir_resources``.
    """
    spark = bundles.sparkSession
    staged = f"{database}.fhir_resources"
    parsed = (fhir_resources(bundles, col).sortWithinPartitions("kind") if whole
              else fhir_entries(bundles, col).sortWithinPartitions("resourceType"))
    table_overwrite_sink(parsed, staged)
    loaded = {}
    for table, transform in TRANSFORMS.items():
        stored = spark.table(staged)
        entries = entries_of(stored, [RESOURCE_OF_TABLE[table]]) if whole else stored
        table_overwrite_sink(transform(entries), f"{database}.{table}")
        loaded[table] = spark.table(f"{database}.{table}")
    return loaded


def condition_features(
    conditions: DataFrame, persons: DataFrame | None = None, include_all: bool = False
) -> DataFrame:
    """Per person one 0/1 flag for each tracked condition.

    Only persons with a tracked code have a row. With ``include_all`` every row of ``persons``
    has one, with zeros where nothing was found.
    """
    code = F.col("condition_source_value")
    tracked = reduce(lambda a, b: a + b, v.FEATURE_CODES.values())
    flags = (
        conditions.where(code.isin(tracked))
        .groupBy("person_id")
        .agg(*[
            F.max(F.when(code.isin(codes), 1).otherwise(0)).alias(flag)
            for flag, codes in v.FEATURE_CODES.items()
        ])
    )
    if not include_all:
        return flags
    if persons is None:
        raise ValueError("include_all needs the persons")
    names = list(v.FEATURE_CODES)
    return persons.select("person_id").join(flags, "person_id", "left").na.fill(0, names)
