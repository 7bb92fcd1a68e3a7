"""Token counts as delta-maintained rollups.

Documents are counted by one or more tokenizer versions. Changes carry the counts from before and
after: an insert has no before, a delete no after, a revision both. Each batch is reduced to signed
sums by source, language and tokenizer, and only those are stored, so that totals are the sum over
all committed batches and nothing is ever counted anew.

A batch writes its sums under a name of its own and becomes valid by one commit row. A batch that
is committed already is left alone; an attempt that died in between was never valid, and its files
are never read. ``folded`` turns a store of many batches into one sum that knows them all.

Defined cases: NULL text counts 0 tokens; NULL source or language is a group of its own; groups
whose documents and tokens have cancelled out are not listed; a change that repeats within a batch
counts each time (ids are the caller's; a batch's name is what makes it idempotent); an empty batch
is committed and adds nothing; columns other than those named are not read.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.staging import bounded_batches, word_count

#: Fixed value: the split pattern that belongs to the byte-level vocabularies.
BYTE_BPE_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
DIMENSIONS = ["source", "lang", "tokenizer"]
SUMS = "source string, lang string, tokenizer string, docs long, tokens long"


def bpe_counts(texts: DataFrame, columns: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``texts`` with ``columns`` of text replaced by their number of tokens.

    The driver reads the vocabulary (under 2 MB) and sends it along, so executors need no file.
    """
    bounded_batches(texts.sparkSession)
    with open(vocabulary, "rb") as file:
        lines = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        encoding = tiktoken.Encoding("byte_bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})
        for batch in batches:
            out = []
            for name, column in zip(batch.schema.names, batch.columns):
                if name in columns:
                    column = pa.array([len(encoding.encode_ordinary(t)) if t else 0
                                       for t in column.to_pylist()], pa.int64())
                out.append(column)
            yield pa.RecordBatch.from_arrays(out, names=batch.schema.names)

    kinds = [f"`{f.name}` " + ("bigint" if f.name in columns else f.dataType.simpleString())
             for f in texts.schema.fields]
    return texts.mapInArrow(run, ", ".join(kinds))


def signed_sums(changes: DataFrame) -> DataFrame:
    """Sums of a batch from rows ``before`` and ``after``: structs of source, lang, tokenizer and
    tokens, NULL where there was or is no document."""
    signed = changes.select(F.explode(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")))).alias("x")).select("x.*")
    return (signed.filter("row IS NOT NULL").select("sign", "row.*").groupBy(*DIMENSIONS)
            .agg(F.sum("sign").cast("long").alias("docs"),
                 F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens")))


def new_store(spark: SparkSession, path: str) -> str:
    """An empty store at ``path``."""
    spark.createDataFrame([], SUMS).coalesce(1).write.parquet(f"{path}/sums/attempt=start")
    _commit(spark, path, "", "start")
    return path


def _commit(spark: SparkSession, path: str, batch: str, attempt: str) -> None:
    spark.createDataFrame([(batch, attempt)], "batch string, attempt string").coalesce(1).write.mode(
        "append").parquet(f"{path}/commits")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``batch, attempt``; of two attempts of a batch that both got through, one counts."""
    return (spark.read.schema("batch string, attempt string").parquet(f"{path}/commits")
            .groupBy("batch").agg(F.min("attempt").alias("attempt")))


def commit_batch(spark: SparkSession, path: str, batch: str, changes: DataFrame) -> bool:
    """Add a batch of changes; False if it had been committed before."""
    if not committed(spark, path).filter(F.col("batch") == batch).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    signed_sums(changes).write.parquet(f"{path}/sums/attempt={attempt}")
    _commit(spark, path, batch, attempt)
    return True


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` over all committed batches."""
    sums = spark.read.schema(SUMS + ", attempt string").parquet(f"{path}/sums")
    valid = committed(spark, path).select("attempt").distinct()
    return (sums.join(valid, "attempt", "left_semi").groupBy(*DIMENSIONS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .filter("docs <> 0 OR tokens <> 0"))


def folded(spark: SparkSession, path: str, to: str) -> str:
    """A new store with the same totals and the same known batches, in one set of sums."""
    totals(spark, path).write.parquet(f"{to}/sums/attempt=folded")
    committed(spark, path).select("batch", F.lit("folded").alias("attempt")).write.parquet(f"{to}/commits")
    return to


def image(tokenizer, tokens, present=None) -> F.Column:
    """A before- or after-image of the current row."""
    row = F.struct(F.col("source"), F.col("lang"), F.lit(tokenizer).alias("tokenizer"),
                   tokens.cast("long").alias("tokens"))
    return row if present is None else F.when(present, row)


def counted(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, lang`` with counts of the text (``bpe, words``) and of the text without its
    first line, where ``revised`` is true (``bpe_after, words_after``)."""
    after = F.when(F.col("revised"), F.regexp_replace("text", r"^[^\n]*\n?", ""))
    texts = documents.withColumn("after", after).select(
        "doc_id", "source", "lang", "revised", "deleted", word_count(F.col("text")).alias("words"),
        word_count(F.col("after")).alias("words_after"), F.col("text").alias("bpe"),
        F.col("after").alias("bpe_after"))
    return bpe_counts(texts, ["bpe", "bpe_after"], vocabulary)
