"""HL7 v2 ADT messages: build, parse, segments, components.

Parsing is built-in expressions on the message text, one row in and one row out: a single narrow
stage without a Python process. Field numbers are those of the standard; in MSH the separator
itself counts as field 1.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import vocabulary as v

# --- Fixed values ---
ENCODING_CHARACTERS = "^~\\&"
# Signs with a meaning and how plain text writes them; the escape sign itself comes first.
ESCAPES = [
    ("\\", "\\E\\"), ("|", "\\F\\"), ("^", "\\S\\"), ("~", "\\R\\"), ("&", "\\T\\"),
    ("\r", "\\X0D\\"), ("\n", "\\X0A\\"),
]
NO_TEXT = "no message text"
NOT_MSH = "first segment is not MSH"
SHORT_MSH = "MSH segment ends before field 9"
# Segments that a segment belongs to; the nearest one before it counts.
SEGMENT_PARENTS = {
    "PD1": ("PID",), "NK1": ("PID",), "PV1": ("PID",), "PV2": ("PV1",), "DG1": ("PID",),
    "PR1": ("PID",), "ROL": ("PR1", "PV1", "PID"), "IN1": ("PID",), "IN2": ("IN1",), "IN3": ("IN1",),
    "ORC": ("PID",), "OBR": ("ORC", "PID"), "OBX": ("OBR", "PID"), "SPM": ("OBR",),
    "NTE": ("OBX", "OBR", "ORC", "PID"),
}
# --- End of fixed values ---

PARSED_COLUMNS = ["patient_id", "admit_location", "admit_diagnosis", "message_type", "facility"]

# Holds the place of a literal pipe in a message that uses another separator.
_PIPE_ASIDE = "\u0001"


def _trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(" \t\r\n\x0b\x0c"))


def _separator(message: Column) -> Column:
    return F.substring(message, 4, 1)


def _normalised(text: Column) -> Column:
    """Trimmed message with the pipe as field separator.

    The separator is the fourth character. Where it is not the pipe, it becomes one and literal
    pipes are set aside; ``_restored`` brings them back in the values.
    """
    message = _trimmed(text)
    separator = _separator(message)
    uses_pipe = (separator == "|") | ~message.startswith("MSH")
    swapped = F.call_function(
        "translate", message, F.concat(separator, F.lit("|")), F.lit("|" + _PIPE_ASIDE)
    )
    return F.when(uses_pipe, message).otherwise(swapped)


def _restored(value: Column) -> Column:
    aside = value.contains(_PIPE_ASIDE)
    return F.when(aside, F.translate(value, _PIPE_ASIDE, "|")).otherwise(value)


def _lines(message: Column) -> Column:
    """Segment texts. Both line ends count; a CR LF pair leaves an empty text between."""
    return F.split(F.replace(message, F.lit("\n"), F.lit("\r")), "\r")


def _types(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.substring_index(line, "|", 1))


def _first_segment(lines: Column, types: Column, segment: str) -> Column:
    """Pieces of the first segment of a type, NULL if there is none."""
    place = (F.array_position(types, segment) - 1).cast("int")
    return F.split(F.get(lines, place), r"\|")


def _field(pieces: Column, segment: str, number: int) -> Column:
    """Field of a segment, '' if the segment is missing or too short."""
    place = number - 1 if segment == "MSH" else number
    return F.coalesce(F.get(pieces, F.lit(place)), F.lit(""))


def hl7_field(text: Column, segment: str, field: int) -> Column:
    """Field of the first segment of a type: '' if missing, NULL for NULL text.

    Composites are kept whole. In messages with the pipe as separator the segment is found by one
    search, and only its own line is cut; others are cut as a whole. For many fields of a message
    use ``hl7_parse_adt`` with ``extra``, which cuts the text once for all of them.
    """
    message = _trimmed(text)
    if segment == "MSH" and field == 1:
        separator = F.when(message.startswith("MSH"), _separator(message))
        return F.when(text.isNotNull(), F.coalesce(separator, F.lit("")))
    uses_pipe = (_separator(message) == "|") | ~message.startswith("MSH")
    line = F.regexp_extract(
        message, rf"(?:^|[\r\n])({segment}(?:\|[^\r\n]*)?)(?![^\r\n])", 1)
    found = _field(F.split(line, r"\|"), segment, field)
    lines = _lines(_normalised(text))
    other = _restored(_field(_first_segment(lines, _types(lines), segment), segment, field))
    return F.when(text.isNotNull(), F.when(uses_pipe, found).otherwise(other))


def hl7_parse_adt(
    df: DataFrame,
    col: str = "value",
    keep: Sequence[str] = (),
    extra: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """The five admission fields of each message, and whether it could be parsed.

    A message that cannot be parsed keeps its row: all fields are empty and ``facility`` tells
    the cause. ``keep`` carries columns of ``df`` along, ``extra`` names further fields to read,
    for instance ``{"message_time": ("MSH", 7)}``.
    """
    extra = dict(extra or {})
    segments = list(dict.fromkeys(["MSH", "EVN", "PID", "DG1"] + [s for s, _ in extra.values()]))

    # One step per select: the text is cut into lines once, and each line is named once.
    message = df.select(*keep, _normalised(F.col(col)).alias("_message"))
    lines = message.select(
        *keep,
        F.when(F.col("_message").isNull(), NO_TEXT)
        .when(~F.col("_message").startswith("MSH"), NOT_MSH)
        .when(~F.col("_message").rlike(r"^MSH(?:\|[^|\r\n]*){8}"), SHORT_MSH)
        .alias("_cause"),
        _lines(F.col("_message")).alias("_lines"),
    )
    named = lines.select(*keep, "_cause", "_lines", _types(F.col("_lines")).alias("_types"))
    parts = named.select(
        *keep,
        "_cause",
        *[_first_segment(F.col("_lines"), F.col("_types"), s).alias(f"_{s}") for s in segments],
    )

    places = {
        "patient_id": ("PID", 3),
        "event_location": ("EVN", 7),
        "admit_diagnosis": ("DG1", 3),
        "message_type": ("MSH", 9),
        "facility": ("MSH", 3),
        **{f"extra_{name}": place for name, place in extra.items()},
    }
    fields = parts.select(
        *keep,
        "_cause",
        *[
            _field(F.col(f"_{segment}"), segment, number).alias(f"_field_{name}")
            for name, (segment, number) in places.items()
        ],
    )

    def field(name: str, failed: Column | None = None) -> Column:
        parsed = F.when(F.col("_cause").isNull(), _restored(F.col(f"_field_{name}")))
        return parsed.otherwise(F.lit("") if failed is None else failed)

    failure = F.concat(
        F.lit(v.PARSE_ERROR_PREFIX), F.substring(F.col("_cause"), 1, v.PARSE_CAUSE_LENGTH)
    )
    located = F.col("_field_event_location") != ""
    return fields.select(
        *keep,
        field("patient_id").alias("patient_id"),
        F.when(located, field("event_location")).otherwise(field("facility"))
        .alias("admit_location"),
        field("admit_diagnosis").alias("admit_diagnosis"),
        field("message_type").alias("message_type"),
        field("facility", failure).alias("facility"),
        *[field(f"extra_{name}").alias(name) for name in extra],
        F.col("_cause").isNotNull().alias("is_parse_error"),
    )


def hl7_parse_errors(parsed: DataFrame) -> DataFrame:
    """The rows of messages that could not be parsed."""
    return parsed.where("is_parse_error")


def hl7_segments(
    df: DataFrame,
    col: str = "value",
    keep: Sequence[str] = (),
    parents: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per segment: type, place in the message, and fields.

    ``fields[n]`` is field n for every type, ``fields[0]`` the type. Text that does not start
    with MSH has no segments; ``hl7_parse_errors`` lists it.

    With ``parents``, for instance ``SEGMENT_PARENTS``, there is ``parent_index`` too: the place of
    the last segment before this one whose type is among those named for its type, NULL where
    there is none or no type is named. So repeated groups stay apart. The places are found by one
    fold over the segments, within the row.
    """
    # No filter on the text or its segments: one would move below a shuffle and past the step that
    # makes the text, which would be made again for each condition.
    message = df.select(*keep, _trimmed(F.col(col)).alias("_message"))
    separated = message.select(*keep, _separator(F.col("_message")).alias("_separator"), "_message")
    segments = F.when(F.col("_message").startswith("MSH"), F.filter(
        F.split("_message", r"[\r\n]+"), lambda s: F.length(s) > 0))
    if parents is None:
        split = separated.select(
            *keep, "_separator", F.posexplode(segments).alias("segment_index", "_segment"))
        places = []
    else:
        cut = separated.select(*keep, "_separator", segments.alias("_segments"))
        grouped = cut.withColumn("_parents", _parent_places(_segment_types(), parents))
        placed = grouped.select(
            *keep, "_separator",
            F.posexplode(F.arrays_zip("_segments", "_parents")).alias("segment_index", "_placed"))
        split = placed.select(
            *keep, "_separator", "segment_index", F.col("_placed._segments").alias("_segment"),
            F.col("_placed._parents").alias("parent_index"))
        places = ["parent_index"]
    quoted = F.concat(F.lit("\\Q"), F.col("_separator"), F.lit("\\E"))
    pieces = F.when(F.col("_separator") == "|", F.split("_segment", r"\|")).otherwise(
        F.split("_segment", quoted)
    )
    fields = split.select(*keep, "segment_index", *places, "_separator", pieces.alias("_pieces"))
    return fields.select(
        *keep,
        "segment_index",
        *places,
        F.get("_pieces", 0).alias("segment_type"),
        F.when(
            F.get("_pieces", 0) == "MSH", F.array_insert("_pieces", 2, F.col("_separator"))
        ).otherwise(F.col("_pieces")).alias("fields"),
    )


def _segment_types() -> Column:
    return F.transform("_segments", lambda s: F.regexp_extract(s, "^[A-Za-z0-9]+", 0))


def _parent_places(types: Column, parents: Mapping[str, Sequence[str]]) -> Column:
    """For each segment the place of its parent, by a fold that holds the last place of each type."""
    held = sorted({name for names in parents.values() for name in names})
    nowhere = F.lit(None).cast("int")

    def step(state: Column, kind: Column) -> Column:
        place = F.size(state["places"])
        last = {name: F.get(state["last"], F.lit(n)) for n, name in enumerate(held)}
        parent = nowhere
        for child, names in parents.items():
            nearest = F.greatest(nowhere, nowhere, *[last[name] for name in names])
            parent = F.when(kind == child, nearest).otherwise(parent)
        return F.struct(
            F.array(*[F.when(kind == name, place).otherwise(last[name]) for name in held]).alias("last"),
            F.concat(state["places"], F.array(parent)).alias("places"))

    start = F.struct(F.array(*[nowhere for _ in held]).alias("last"),
                     F.array().cast("array<int>").alias("places"))
    return F.aggregate(types, start, step, lambda state: state["places"])


def hl7_components(field: Column, encoding: Column | None = None) -> Column:
    """Parts of a composite field. ``encoding`` is MSH-2 where a message may choose its own signs."""
    if encoding is None:
        return F.split(field, r"\^")
    return _cut(field, encoding, 1)


def _cut(text: Column, encoding: Column, place: int) -> Column:
    standard = ENCODING_CHARACTERS[place - 1]
    sign = F.substring(encoding, place, 1)
    sign = F.when(F.length(sign) == 1, sign).otherwise(F.lit(standard))
    quoted = F.concat(F.lit("\\Q"), sign, F.lit("\\E"))
    return F.split(text, quoted)


def hl7_component(field: Column, number: int, encoding: Column | None = None) -> Column:
    """Part of a composite field, counted from 1; NULL beyond its end."""
    return F.try_element_at(hl7_components(field, encoding), F.lit(number))


def hl7_repetitions(field: Column, encoding: Column | None = None) -> Column:
    """The values of a field that repeats."""
    return _cut(field, F.lit(ENCODING_CHARACTERS) if encoding is None else encoding, 2)


def hl7_subcomponents(component: Column, encoding: Column | None = None) -> Column:
    """Parts of a component."""
    return _cut(component, F.lit(ENCODING_CHARACTERS) if encoding is None else encoding, 4)


def hl7_escaped(text: Column) -> Column:
    """Plain text as it is written into a field: signs with a meaning become escapes."""
    for sign, escape in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(escape))
    return text


def hl7_unescaped(text: Column) -> Column:
    """The plain text of a value, read from left to right; unknown escapes stay."""
    known = F.create_map(*[F.lit(x) for sign, escape in ESCAPES for x in (escape, sign)])
    pieces = F.regexp_extract_all(text, F.lit(r"\\(?:[EFSRT]|X0[AD])\\|[^\\]+|\\"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.coalesce(known[x], x)), "")


@dataclass(frozen=True)
class Segment:
    """A segment to build: plain text per field number, or a list of plain texts for components.

    ``when`` leaves the segment out where it is not true. With ``each``, an array, there is one
    segment per element, and ``fields`` is a function of the element and its place from 0.
    """

    name: str
    fields: Mapping[int, Column | Sequence[Column]] | Callable
    when: Column | None = None
    each: Column | None = None


def _written(name: str, fields: Mapping[int, Column | Sequence[Column]]) -> Column:
    def value(number: int) -> Column:
        given = fields.get(number)
        if given is None:
            return F.lit("")
        if name == "MSH" and number == 2:
            return given
        parts = [given] if isinstance(given, Column) else given
        return F.concat_ws("^", *[F.coalesce(hl7_escaped(x), F.lit("")) for x in parts])

    first = 2 if name == "MSH" else 1
    return F.concat_ws("|", F.lit(name), *[value(n) for n in range(first, max(fields, default=0) + 1)])


def _repeated(segment: Segment) -> Column:
    return F.transform(segment.each, lambda x, i: _written(segment.name, segment.fields(x, i)))


def hl7_build_adt(
    df: DataFrame,
    segments: Sequence[Segment],
    segment_end: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Message text from columns, as ``value``: the segments in the order given.

    The encoding characters of MSH-2 are filled in; everything else comes from the columns.
    """
    parts = []
    for segment in segments:
        if segment.each is not None:
            parts.append(_repeated(segment))
            continue
        fields = dict(segment.fields)
        if segment.name == "MSH":
            fields = {2: F.lit(ENCODING_CHARACTERS), **fields}
        text = _written(segment.name, fields)
        parts.append(text if segment.when is None else F.when(segment.when, text))
    end = F.lit("\r") if segment_end is None else segment_end
    return df.select(*keep, F.concat(F.call_function("concat_ws", end, *parts), end).alias("value"))
