"""Landed files: HL7 messages, XML documents, FHIR Bundles, and the landing folder itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

# Block framing of HL7 messages in a file that holds many of them.
FRAME_START = "\x0b"
FRAME_END = "\x1c\r"


# Where a record begins or ends in plain text, and what may stand before its begin.
MESSAGE_START = "MSH|"
BUNDLE_START = "{"
LINE_ENDS = ["\r", "\n", FRAME_START]
BUNDLE_ENDS = ["}\n", "}\r\n"]
#: Records looked at to see which of several forms of the separator files use.
LOOKED_AT = 1000


def separator_in_use(
    spark: SparkSession, path: str | Sequence[str], start: str, ends: Sequence[str]
) -> str:
    """The most frequent end of a record, among the first ones that Spark reads below ``path``.

    This only decides how files are split. Records with another end are found in the rows, so the
    result is the same with any choice. Where nothing has landed yet, the first form is taken.
    """
    try:
        rows = spark.read.text(path, lineSep=start).limit(LOOKED_AT)
        counts = rows.agg(*[F.count(F.when(F.col("value").endswith(e), 1)) for e in ends]).first()
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return ends[0]
    return max(zip(counts, range(0, -len(ends), -1), ends))[2]


def hl7_text_options(
    reader: DataFrameReader | DataStreamReader, framed: bool, line_end: str = LINE_ENDS[0]
):
    """Rows that end where a block frame ends, or where a message begins after a line end.

    Either way large files are split.
    """
    separator = FRAME_END if framed else line_end + MESSAGE_START
    return reader.format("text").option("lineSep", separator)


def unframed(messages: DataFrame, framed: bool) -> DataFrame:
    """One row per message: a line that begins with MSH begins a message, frames are taken off.

    A row of a plain file has lost the begin of its message to the separator; it is told by the
    encoding characters that follow. Text before the first MSH is a row of its own, and becomes a
    parse error. What is left after the last frame, and other blank text, is no message.
    """
    frames = F.lit(FRAME_START + FRAME_END + "\n \t")
    if framed:
        return messages.withColumn("value", F.ltrim(F.col("value"), F.lit(FRAME_START + "\r\n"))).where(
            F.btrim("value", frames) != "")
    begun = F.col("value").rlike(r"^[^\w\s|]{1,5}(?:\||[\r\n]|$)")
    whole = F.when(begun, F.concat(F.lit(MESSAGE_START), F.col("value"))).otherwise(F.col("value"))
    pieces = F.split(whole, r"\x1c|(?<=[\r\n\x0b])(?=MSH[^\w\s])")
    kept = F.filter(F.transform(pieces, lambda m: F.ltrim(m, F.lit(FRAME_START + "\r\n"))),
                    lambda m: F.btrim(m, frames) != "")
    return messages.withColumn("value", F.explode(kept))


def hl7_file_scan(spark: SparkSession, path: str, framed: bool = False) -> DataFrame:
    """Messages below ``path`` as ``value``, one row per message.

    Files may hold one message or many, and large ones are split between messages. ``framed`` is
    for files with block frames, where a message may hold anything. Millions of tiny files cost
    more to list and open than to parse.
    """
    end = LINE_ENDS[0] if framed else separator_in_use(spark, path, MESSAGE_START, LINE_ENDS)
    return unframed(hl7_text_options(spark.read, framed, end).load(path), framed)


def write_framed_messages(messages: DataFrame, path: str, messages_per_file: int = 0) -> None:
    """Land the ``value`` column as block-framed files."""
    writer = messages.select(F.concat(F.lit(FRAME_START), F.col("value")).alias("value")).write
    if messages_per_file:
        writer = writer.option("maxRecordsPerFile", messages_per_file)
    writer.option("lineSep", FRAME_END).text(path)


def provenance_columns(df: DataFrame) -> DataFrame:
    """Add the file a row came from and the time it was read. ``df`` must be a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("parsed_at"),
    )


def xml_scan(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: StructType,
    one_per_line: bool = False,
) -> DataFrame:
    """One row per ``row_tag`` element, read with an explicit schema.

    Rows end at the element's end tag, so large files are split between elements. Text without
    such an element is one row, which the parser marks as corrupt. A file that was cut off counts
    as its elements and a corrupt one; only if the cut is exactly behind a child of the element it
    looks complete, and ``cut_off_files`` finds it. ``one_per_line`` is for files with one document
    per line, which need no repair.
    """
    if one_per_line:
        reader = spark.read.format("xml").option("rowTag", row_tag).option("multiLine", "false")
        return reader.schema(schema).load(path)
    pieces = xml_file_texts(spark, path, row_tag)
    options = {"rowTag": row_tag, "columnNameOfCorruptRecord": "_corrupt_record"}
    return pieces.select(F.from_xml("value", schema, options).alias("row")).select("row.*")


def xml_file_texts(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """The text of each ``row_tag`` element below ``path`` as ``value``; large files are split.

    What stands before the element in its row (declarations, comments, other text) is cut off, and
    the end tag put back. Rows with an element that ends in another form, with a space in its tag
    or without content, are searched for all their elements.
    """
    end, text = f"</{row_tag}>", F.col("value")
    begin = F.regexp_instr(text, F.lit(rf"<{row_tag}[\s>]"))
    other = text.rlike(rf"</{row_tag}\s+>|<{row_tag}(?:\s[^>]*)?/>")
    ended = F.concat(F.substr(text, begin), F.lit(end))
    pieces = (
        F.when(other, _elements(F.concat(text, F.lit(end)), row_tag))
        .when(begin > 0, F.array(ended))
        .when(text.rlike(r"\S") & ~text.rlike(rf"(?s)^\s*(?:(?:<\?.*?\?>|<!--.*?-->)\s*)+$"),
              F.array(text)))
    rows = spark.read.text(path, lineSep=end)
    return rows.withColumn("value", F.explode(pieces))


def cut_off_files(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """``path`` of the files whose last element has no end tag, by the sizes of their rows.

    Every row but the last one took an end tag with it. If the last one did too, or is blank, the
    file is complete. Rows are summed up per file before the shuffle.
    """
    end = f"</{row_tag}>"
    rows = spark.read.text(path, lineSep=end).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.octet_length("value").alias("bytes"),
        F.col("value").rlike(rf"<{row_tag}[\s>]").alias("begun"))
    sums = rows.groupBy("path", "size").agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.count_if("begun").alias("begun"))
    tags = (F.col("size") - F.col("bytes")) / len(end)
    return sums.where(F.col("begun") > tags).select("path")


def _elements(text: Column, row_tag: str) -> Column:
    element = rf"(?s)<{row_tag}(?:\s[^>]*?)?(?:/>|>.*?</{row_tag}\s*>)"
    return F.regexp_extract_all(text, F.lit(element), F.lit(0))


def xml_texts(files: DataFrame, row_tag: str) -> DataFrame:
    """The text of each ``row_tag`` element in ``value``, one row per element.

    For texts at hand; files are split by ``xml_file_texts``. Keep it beside the parsed columns to
    have what the schema leaves out.
    """
    found = files.withColumn("_found", _elements(F.col("value"), row_tag))
    some = F.when(F.size("_found") > 0, F.col("_found")).when(
        F.col("value").rlike(r"\S"), F.array("value"))
    return found.withColumn("value", F.explode(some)).drop("_found")


def fhir_bundle_scan(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Bundles below a path or glob as JSON text in ``value``.

    Files may hold one Bundle or many, each beginning on a new line after the end of the one
    before; large files are split there. Within JSON a line end never parts two braces without a
    comma, and in its strings line ends are escaped. Rows have lost the braces at the separator: a
    row that doesn't begin with one gets it back, and so does one that is only whole with a brace
    at its end, for which its JSON is gone through. ``one_per_line`` saves that.
    """
    if one_per_line:
        return spark.read.text(path)
    end = separator_in_use(spark, path, BUNDLE_START, BUNDLE_ENDS)
    rows = spark.read.text(path, lineSep=end + BUNDLE_START)
    text = F.col("value")
    # A file's first row keeps its brace, unless blank text precedes it.
    begun = F.when(F.ltrim(text, F.lit(" \t\r\n\ufeff")).startswith(BUNDLE_START), text).otherwise(
        F.concat(F.lit(BUNDLE_START), text))
    split = F.filter(F.split(begun, r"(?<=\})[ \t]*[\r\n]\s*(?=\{)"), lambda b: b.rlike(r"\S"))
    # Most rows are one Bundle on one line: nothing to look for.
    pieces = F.when(text.contains("\n") | text.contains("\r"), split).otherwise(F.array(begun))
    cut = rows.where(text.rlike(r"\S")).withColumn("value", F.explode(pieces))
    ended = F.concat(text, F.lit("}"))
    lacking = F.json_object_keys(text).isNull() & F.json_object_keys(ended).isNotNull()
    return cut.withColumn("value", F.when(lacking, ended).otherwise(text))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and time of the files below ``path``; their content is not read.

    Files without content, which no scan would return a row for, are not listed.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def landing_file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Number and size of the landed files."""
    return landing_files(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def landing_file_listing(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first ``n`` landed files by path."""
    return landing_files(spark, path).orderBy("path").limit(int(n))
