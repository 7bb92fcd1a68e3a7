"""C-CDA documents to sections and medication rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

# --- Fixed values: element names of the C-CDA standard. ---
ROW_TAG = "ClinicalDocument"
MEDICATIONS_TITLE = "Medications"
# --- End of fixed values. ---

CORRUPT = "_corrupt_record"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT = StringType()
_ID = _struct(_root=_TEXT, _extension=_TEXT)
_CODE = _struct(_code=_TEXT, _codeSystem=_TEXT, _displayName=_TEXT)
_NAME = _struct(given=ArrayType(_TEXT), family=_TEXT)


def _entries(code: StructType) -> ArrayType:
    product = _struct(manufacturedMaterial=_struct(code=code))
    consumable = _struct(manufacturedProduct=product)
    return ArrayType(_struct(substanceAdministration=_struct(consumable=consumable)))


def _body(section: StructType) -> StructType:
    return _struct(structuredBody=_struct(component=ArrayType(_struct(section=section))))


def _people(id_: StructType | None, addr: StructType, **patient) -> ArrayType:
    role = {} if id_ is None else {"id": ArrayType(id_)}
    who = _struct(name=ArrayType(_NAME), **patient)
    return ArrayType(_struct(patientRole=_struct(**role, addr=ArrayType(addr), patient=who)))


# Elements that may repeat are arrays, whether or not a given document repeats them: all are kept,
# and where one is asked for the first counts.
DOCUMENT_SCHEMA = _struct(
    id=_ID,
    title=_TEXT,
    effectiveTime=_struct(_value=_TEXT),
    recordTarget=_people(
        _ID, _struct(city=_TEXT, state=_TEXT, postalCode=_TEXT, country=_TEXT),
        administrativeGenderCode=_CODE, birthTime=_struct(_value=_TEXT),
    ),
    component=_body(_struct(title=_TEXT, code=_CODE, entry=_entries(_CODE))),
    _corrupt_record=_TEXT,
)

# What the medication rows need. The parser's work grows with the schema: to go from text or
# files straight to medications this one takes about a quarter less time.
MEDICATION_SCHEMA = _struct(
    recordTarget=_people(None, _struct(city=_TEXT)),
    component=_body(_struct(title=_TEXT, entry=_entries(_struct(_displayName=_TEXT)))),
)


def document_schema(*fields: str) -> StructType:
    """The part of ``DOCUMENT_SCHEMA`` that holds the named fields (levels joined by dots), and the
    corrupt text.

    Spark's XML parser fills every field of its schema, used or not, and most of its time goes into
    the nested ones. The whole text is read with any part, and arrays keep their length.
    """
    return _part(DOCUMENT_SCHEMA, [field.split(".") for field in (*fields, CORRUPT)])


def _part(kind: DataType, paths: list[list[str]]) -> DataType:
    if [] in paths:
        return kind
    if isinstance(kind, ArrayType):
        return ArrayType(_part(kind.elementType, paths))
    wanted: dict[str, list[list[str]]] = {}
    for first, *rest in paths:
        wanted.setdefault(first, []).append(rest)
    unknown = set(wanted) - set(kind.names if isinstance(kind, StructType) else ())
    if unknown:
        raise ValueError(f"not in the document schema: {', '.join(sorted(unknown))}")
    return StructType([
        StructField(f.name, _part(f.dataType, wanted[f.name])) for f in kind.fields if f.name in wanted])


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def patient_role() -> Column:
    """The first patient of a document."""
    return _first(F.col("recordTarget"))["patientRole"]


def patient_name() -> Column:
    """The first name of the first patient."""
    return _first(patient_role()["patient"]["name"])


def patient_address() -> Column:
    """The first address of the first patient."""
    return _first(patient_role()["addr"])


def ccda_documents(
    df: DataFrame,
    col: str = "value",
    keep: Sequence[str] = (),
    schema: StructType = DOCUMENT_SCHEMA,
) -> DataFrame:
    """Documents held as text in a column, one row per document.

    Text that is no XML keeps its row: the elements are NULL and the text is in
    ``_corrupt_record``. To have elements outside the schema at hand later, keep the text column
    too. Files are read by ``xml_scan`` with the same schema.
    """
    document = F.from_xml(
        F.col(col), schema, {"rowTag": ROW_TAG, "columnNameOfCorruptRecord": CORRUPT}
    )
    return df.select(*keep, document.alias("_document")).select(*keep, "_document.*")


def ccda_sections(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per body section: the patient of the document, the title and the entries."""
    name = patient_name()
    return documents.select(
        *keep,
        patient_address()["city"].alias("city"),
        _first(name["given"]).alias("first_name"),
        name["family"].alias("last_name"),
        F.explode("component.structuredBody.component").alias("_component"),
    ).select(
        *keep,
        "city",
        "first_name",
        "last_name",
        F.col("_component.section.title").alias("title"),
        F.col("_component.section.entry").alias("entries"),
    )


def ccda_medications(documents: DataFrame) -> DataFrame:
    """Distinct patient and medication names of the Medications sections.

    The first given name counts. Copies are removed within each task before the shuffle.
    """
    product = "_entry.substanceAdministration.consumable.manufacturedProduct"
    return (
        ccda_sections(documents)
        .where(F.col("title") == MEDICATIONS_TITLE)
        .select("city", "first_name", "last_name", F.explode("entries").alias("_entry"))
        .select(
            "city",
            "first_name",
            "last_name",
            F.col(f"{product}.manufacturedMaterial.code._displayName").alias("medication_name"),
        )
        .distinct()
    )
