"""The registered queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (
    decontaminate, language, licenses, merkle, mixture, neardup, quality, secrets, substrings,
    tokencounts, urls, vectors, whitening)
from wardflow.llm.staging import staged
from wardflow.session import scratch_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % of


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"),
                                  _table(spark, sf_dir, "labels"), _fold(5) == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(_table(spark, sf_dir, "documents"), _fold(4) == 2)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).drop("key")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted, a tenth revised, a tenth deleted, and the first batch sent twice."""
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", "lang", F.coalesce(_fold(10) == 1, F.lit(False)).alias("revised"),
        F.coalesce(_fold(10) == 0, F.lit(False)).alias("deleted"))
    counts = staged(tokencounts.counted(documents), "counts")
    image = tokencounts.image

    def changes(before: Callable, after: Callable, rows: DataFrame) -> DataFrame:
        parts = [rows.select(before(name), after(name)) for name in ("bpe", "words")]
        return parts[0].union(parts[1])

    def present(name: str) -> Column:
        return image(name, F.col(name)).alias("after")

    inserts = changes(lambda n: F.when(F.lit(False), image(n, F.col(n))).alias("before"), present, counts)
    revisions = changes(lambda n: image(n, F.col(n)).alias("before"),
                        lambda n: image(n, F.col(f"{n}_after")).alias("after"), counts.filter("revised"))
    deletes = changes(lambda n: image(n, F.col(n)).alias("before"),
                      lambda n: F.when(F.lit(False), image(n, F.col(n))).alias("after"),
                      counts.filter("deleted"))
    store = tokencounts.new_store(spark, f"{scratch_folder(spark)}/token-counts")
    for batch, rows in (("load", inserts), ("revise", revisions), ("delete", deletes), ("load", inserts)):
        tokencounts.commit_batch(spark, store, batch, rows)
    return tokencounts.totals(spark, store)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(_table(spark, sf_dir, "documents"))


def op9_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed_sizes(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return urls.judged_urls(pages, urls.host_word_list(pages))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = merkle.verified_documents(_table(spark, sf_dir, "documents"))
    return seen.select("doc_id", "leaf", "subroot", "root",
                       merkle.digest(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
                       "folded_root", "verified")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_language_id, op3_benchmark_decontamination, op4_substring_dedup, op5_minhash_near_dedup,
    op6_token_counts, op7_embedding_near_dedup, op8_secret_scan, op9_source_mixture, op10_url_filter,
    op11_merkle_manifest, op12_license_scan, op13_embedding_whitening)}
