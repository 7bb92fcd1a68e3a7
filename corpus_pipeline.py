"""The corpus pipeline: documents through five stages, each calling one of the corpus operators.

Every stage works on all rows its predecessor kept, and all but the last return the columns of
``documents``, whatever their names. NULL texts, empty texts and repeated rows pass through the
stages as the operators define them: a text without letters has no language and goes, rows with
equal texts are one group of which one stays, and a text without words takes no part in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, language, mixture, neardup, secrets
from wardflow.llm.staging import keyed, staged


def _rows(docs: DataFrame) -> DataFrame:
    """``key`` (unique) and ``row`` with all columns, so that no name can clash."""
    return keyed(docs.select("doc_id", F.struct("*").alias("row")), "doc_id", "row")


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose key is not among the ids of ``gone``.

    The ids are written first, so Spark knows their size when it chooses between a broadcast of
    the ids and a shuffle of the texts.
    """
    ids = staged(gone.select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return rows.join(ids, F.col("key") == F.col("gone"), "left_anti").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, by dictionaries learned from the labelled ones."""
    dictionaries = language.learned_dictionaries(docs)
    rows = docs.select(F.struct("*").alias("row"), "text")
    return (language.predicted_languages(rows, dictionaries)
            .filter("NOT rejected").select("row.*"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity of 0.8 or more)."""
    rows = _rows(docs)
    judged = neardup.near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"),
                                     size=5, percent=80)
    return _without(rows, judged.filter("NOT kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = _rows(docs)
    found = decontaminate.contaminated(rows.select(F.col("key").alias("doc_id"), "row.text"),
                                       spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(rows, found)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and ``n_chars`` counted anew there."""
    return secrets.redacted(docs, secrets.learned_formats(docs))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, with the number of the ``copy``."""
    return mixture.mix(docs)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("source mixture", source_mixture),
]

#: SQL cannot express most stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to all documents, each to the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"stage-{number}")
    return docs
