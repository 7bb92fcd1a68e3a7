"""HL7 messages as a stream of landing files. All steps are stateless.

The ledgered sink lays out ``rows``, ``errors`` and ``ledger`` below one folder, each in folders by
stream and batch. A batch counts from the moment its ledger row is there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow.operators.hl7 import hl7_parse_adt
from wardflow.sources.files import (
    LINE_ENDS,
    MESSAGE_START,
    hl7_text_options,
    provenance_columns,
    separator_in_use,
    unframed,
)
from wardflow.sources.tables import create_database_of


def stream_hl7_source(
    spark: SparkSession, path: str, max_files: int = 10, framed: bool = False
) -> DataFrame:
    """Messages of newly landed files, at most ``max_files`` files per batch.

    Large files are split between messages, by the line end of what has landed when the stream
    starts. With one message per file raise ``max_files`` to what a batch can hold, or let messages
    be landed in framed files and pass ``framed``.
    """
    end = LINE_ENDS[0] if framed else separator_in_use(spark, path, MESSAGE_START, LINE_ENDS)
    reader = hl7_text_options(spark.readStream, framed, end).option("maxFilesPerTrigger", max_files)
    return unframed(reader.load(path), framed)


def stream_hl7_parse(
    messages: DataFrame, extra: Mapping[str, tuple[str, int]] | None = None
) -> DataFrame:
    """The batch parse on a stream, with the file and time of each message."""
    traced = provenance_columns(messages)
    return hl7_parse_adt(traced, keep=["source_file", "parsed_at"], extra=extra)


def stream_hl7_append(
    parsed: DataFrame, table: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append a parsed stream to a table; a restart with the same checkpoint repeats no file.

    By default the query takes what has landed and ends, otherwise it runs on.
    """
    create_database_of(parsed.sparkSession, table)
    writer = (
        parsed.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(table)


def stream_hl7_ledgered(
    parsed: DataFrame, place: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write a parsed stream to two tables, messages and parse errors, with one commit per batch.

    Both are written under the batch's number, and then a row of counts in the ledger, which makes
    them count for ``ledgered_table``. A run that dies at any point and is started again with the same
    checkpoint replaces what an uncommitted batch left, and leaves a committed one as it is. Another
    checkpoint is another stream, whose batches are told apart.
    """
    spark = parsed.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        folder = f"stream={_stream_id(spark, checkpoint)}/batch={number}"
        if _is_written(spark, f"{place}/ledger/{folder}"):
            return
        batch.persist()
        try:
            _write_part(batch.where("NOT is_parse_error"), f"{place}/rows/{folder}")
            _write_part(batch.where("is_parse_error"), f"{place}/errors/{folder}")
            counts = batch.agg(F.count_if(~F.col("is_parse_error")).alias("rows"),
                               F.count_if("is_parse_error").alias("errors"))
            _write_part(counts.withColumn("committed_at", F.current_timestamp()), f"{place}/ledger/{folder}")
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ledgered_table(spark: SparkSession, place: str, part: str) -> DataFrame:
    """The committed ``rows`` or ``errors`` below ``place``, or the ``ledger`` itself."""
    if part == "ledger":
        return spark.read.parquet(f"{place}/ledger")
    committed = ledgered_table(spark, place, "ledger").select("stream", "batch")
    return spark.read.parquet(f"{place}/{part}").join(committed, ["stream", "batch"], "left_semi")


def _write_part(part: DataFrame, path: str) -> None:
    part.write.mode("overwrite").parquet(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it first used the checkpoint."""
    metadata = spark.read.text(f"{checkpoint}/metadata")
    return metadata.select(F.get_json_object("value", "$.id")).first()[0]


def _is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was completed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)
