"""Intermediate tables, row keys and Arrow batch sizes shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import scratch_folder

#: Words everywhere in this subpackage: runs of anything but space and the five ASCII controls.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The lineage ends there, so a lost executor costs one task and not the history of the table.
    The files stay until the shared folder is cleared: a lazy result may still read them.
    """
    path = f"{scratch_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, id_column: str, *columns: str) -> DataFrame:
    """``key`` (long, unique), the id and ``columns``.

    The key is the id where no id is NULL or repeated; otherwise the rows are staged with a number
    each, because a number that is made anew when a task is repeated could move to another row.
    """
    kept = df.select(F.col(f"`{id_column}`").cast("long").alias(id_column),
                     *[F.col(f"`{c}`") for c in columns])
    rows, different = kept.agg(F.count("*"), F.countDistinct(id_column)).first()
    if rows == different:
        return kept.withColumn("key", F.col(id_column))
    return staged(kept.withColumn("key", F.monotonically_increasing_id()), "keyed")


def bounded_batches(spark: SparkSession, megabytes: int = 16) -> None:
    """Limit the Arrow batches that Python workers get by bytes, so that long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def give_back() -> None:
    """Return to the system what this Python worker has freed.

    Spark keeps workers for later tasks, and Arrow and malloc keep the largest batch they met.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries return memory by themselves
        pass


def frugal(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` that gives memory back after each batch and at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        try:
            yield from step(watched())
        finally:
            give_back()

    return run


def word_count(text) -> F.Column:
    """Words of a text, 0 for NULL; JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text) -> F.Column:
    """Lower case of A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: F.Column, use) -> F.Column:
    """``use`` of a value computed once per row.

    A column that a lambda reads would otherwise be put into the lambda as the expression it stands
    for, and be computed again for each element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
