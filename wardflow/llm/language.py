"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of excerpts from a bounded sample of
labelled documents. A text is compressed with each of them, and the language whose dictionary
leaves the fewest bytes is chosen; a narrow margin to the next one marks the text as rejected.
Texts are compressed whole, but in pieces of ``PIECE`` bytes of which none sees another: a long text
would soon be its own dictionary, and the margin would shrink with its length.

Defined cases: NULL text and text without a letter are ``und`` with score 0 and rejected; so are
all texts if nothing was learned (an empty table, or no label); ties go to the first language in
code-point order and are rejected; with one learned language the score is 1; very long texts are
compressed to their end; rows that repeat a document are predicted each; columns other than those named
are not read, and language, source and id never enter a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from wardflow.llm.staging import bounded_batches, frugal

#: Bounds of the sample: documents per language, characters of each, bytes of a dictionary.
SAMPLE, EXCERPT, DICTIONARY = 300, 600, 96_000
#: The level is one that finds short matches, which is all that short texts have.
LEVEL, MARGIN, SHARPNESS = 12, 0.01, 0.02
#: Bytes that are compressed at once.
PIECE = 8192
_NO_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str) -> bytes:
    """Lower-case letters; everything else is one space."""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode()


def learned_dictionaries(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, bytes]:
    """Dictionary content per language from ``doc_id, text, lang``.

    Only ids are ranked, each task keeps ``sample`` per language, and the chosen ids (that many
    times the number of languages) find their texts again, one per id. An excerpt starts at a place
    that depends on the id, so that common opening lines do not fill the dictionary. Samples of
    under 8 bytes are repeated up to that, the least that a dictionary may have.
    """
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (usable.select("doc_id", "lang").withColumn("n", F.row_number().over(order))
              .filter(F.col("n") <= sample).select("doc_id", "lang").distinct())
    start = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.greatest(F.lit(1), F.length("text") - EXCERPT))
    rows = (usable.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
            .select("lang", "doc_id", F.substr("text", start.cast("int") + 1, F.lit(EXCERPT)).alias("text"))
            .groupBy("lang", "doc_id").agg(F.min("text").alias("text")).collect())
    content: dict[str, bytearray] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.doc_id is None, r.doc_id, r.text)):
        held = content.setdefault(row.lang, bytearray())
        if len(held) < DICTIONARY:
            held += normalised(row.text) + b" "
    return {k: bytes((v * (1 + 8 // len(v)))[:DICTIONARY] if len(v) < 8 else v[:DICTIONARY])
            for k, v in sorted(content.items())}


def sizes_by_language(dictionaries: dict[str, bytes]):
    """A function from normalised bytes to compressed sizes, in the order of the dictionaries.

    The sizes are sums over the pieces, so margins are those of the pieces, however many there are.
    """
    compressors = []
    for content in dictionaries.values():
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        compressors.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
            write_dict_id=False))

    def sizes(text: bytes) -> np.ndarray:
        pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in compressors], float)

    return sizes


def judged(text: str | None, names: list[str], sizes) -> tuple[str, float, bool]:
    """Language, score and rejection of one text."""
    plain = normalised(text) if text else b""
    if not plain or not names or not any(map(str.isalpha, text)):
        return "und", 0.0, True
    size = sizes(plain)
    best = int(size.argmin())
    if len(names) == 1:
        return names[0], 1.0, False
    second = np.partition(size, 1)[1]
    score = 1.0 / np.exp(-(size - size[best]) / (SHARPNESS * size[best])).sum()
    return names[best], float(score), bool(second - size[best] < MARGIN * second)


def predicted_languages(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``documents`` with ``lang_pred, score, rejected`` (in place of columns of these names)."""
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
             StructField("rejected", BooleanType())]
    documents = documents.drop(*[f.name for f in added])
    bounded_batches(documents.sparkSession, 8)
    names = list(dictionaries)
    schema = StructType([*documents.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = sizes_by_language(dictionaries)
        for batch in batches:
            found = [judged(t, names, sizes) for t in batch.column("text").to_pylist()]
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "rejected"])

    return documents.mapInArrow(frugal(run), schema)


def identified(documents: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``; learns from rows that are not held out."""
    marked = documents.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    dictionaries = learned_dictionaries(marked.filter("NOT held_out"))
    return predicted_languages(marked.select("doc_id", "held_out", "text"), dictionaries).drop("text")
