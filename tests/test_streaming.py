"""The stream gives what the batch gives, once."""

import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException

from checks import inputs
from tests.conftest import SMALL
from wardflow.operators.hl7 import hl7_parse_adt
from wardflow.sources import files
from wardflow.streaming import hl7_stream


def test_stream_equals_batch_and_a_restart_takes_only_new_files(spark, tmp_path):
    database = f"s_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    table, state, landing = f"{database}.parsed", f"{tmp_path}/state", f"{tmp_path}/landing"
    messages = inputs.adt_messages(spark, SMALL)
    early, late = messages.where("o_orderkey < 900"), messages.where("o_orderkey >= 900")

    def run(max_files=2):
        source = hl7_stream.stream_hl7_source(spark, f"{landing}/*", max_files, framed=True)
        query = hl7_stream.stream_hl7_append(hl7_stream.stream_hl7_parse(source), table, state)
        query.awaitTermination()
        return query

    def same_as(expected):
        found = spark.table(table).drop("source_file", "parsed_at")
        wanted = hl7_parse_adt(expected)
        return found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()

    files.write_framed_messages(early, f"{landing}/early", messages_per_file=200)
    query = run()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 3 and max(batches) <= 400
    assert same_as(early)
    run()
    assert same_as(early)
    files.write_framed_messages(late, f"{landing}/late", messages_per_file=200)
    run()
    assert same_as(messages)


def test_stream_of_one_message_per_file(spark, tmp_path):
    database = f"s_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    messages = inputs.adt_messages(spark, SMALL).limit(12).cache()
    path = f"{tmp_path}/landing"
    messages.select("value").coalesce(1).write.option("maxRecordsPerFile", 1).text(path)
    source = hl7_stream.stream_hl7_source(spark, path, max_files=5)
    assert source.isStreaming
    parsed = hl7_stream.stream_hl7_parse(source)
    query = hl7_stream.stream_hl7_append(parsed, f"{database}.p", f"{tmp_path}/state")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    found = spark.table(f"{database}.p")
    assert found.where("source_file is null").count() == 0
    assert found.drop("source_file", "parsed_at").exceptAll(hl7_parse_adt(messages)).isEmpty()
    assert found.count() == 12


def ledgered(spark, tmp_path, max_files=2):
    source = hl7_stream.stream_hl7_source(spark, f"{tmp_path}/landing/*", max_files, framed=True)
    parsed = hl7_stream.stream_hl7_parse(source)
    hl7_stream.stream_hl7_ledgered(parsed, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()


def each_message_once(spark, tmp_path, expected):
    wanted = hl7_parse_adt(expected)
    for part, of_part in (("rows", "NOT is_parse_error"), ("errors", "is_parse_error")):
        found = hl7_stream.ledgered_table(spark, f"{tmp_path}/out", part).select(wanted.columns)
        there = wanted.where(of_part)
        assert found.count() == there.count() > 0
        assert found.exceptAll(there).isEmpty() and there.exceptAll(found).isEmpty()
    ledger = hl7_stream.ledgered_table(spark, f"{tmp_path}/out", "ledger").selectExpr("sum(rows)", "sum(errors)")
    assert tuple(ledger.first()) == (wanted.where("NOT is_parse_error").count(), wanted.where("is_parse_error").count())


@pytest.mark.parametrize("dies_at", ["rows", "errors", "ledger"])
def test_a_run_that_dies_within_a_batch_gives_each_message_once(spark, tmp_path, monkeypatch, dies_at):
    """Before each of the writes of the second batch."""
    messages = inputs.adt_messages(spark, SMALL)
    files.write_framed_messages(messages, f"{tmp_path}/landing/a", messages_per_file=200)
    write, seen = hl7_stream._write_part, []

    def dying(part, path):
        seen.append(path)
        if f"/{dies_at}/" in path and path.endswith("batch=1"):
            raise OSError("lost")
        write(part, path)

    monkeypatch.setattr(hl7_stream, "_write_part", dying)
    with pytest.raises(StreamingQueryException):
        ledgered(spark, tmp_path)
    assert len(seen) == 3 + ["rows", "errors", "ledger"].index(dies_at) + 1
    assert hl7_stream.ledgered_table(spark, f"{tmp_path}/out", "ledger").count() == 1
    monkeypatch.setattr(hl7_stream, "_write_part", write)
    ledgered(spark, tmp_path)
    each_message_once(spark, tmp_path, messages)


def test_a_committed_batch_that_is_run_again_is_left_alone(spark, tmp_path):
    """The stream dies after the ledger's row and before its own note of the batch."""
    messages = inputs.adt_messages(spark, SMALL)
    files.write_framed_messages(messages, f"{tmp_path}/landing/a", messages_per_file=400)
    ledgered(spark, tmp_path, max_files=100)
    commits = f"{tmp_path}/state/commits"
    for name in os.listdir(commits):
        os.remove(f"{commits}/{name}")
    before = hl7_stream.ledgered_table(spark, f"{tmp_path}/out", "ledger").collect()
    ledgered(spark, tmp_path, max_files=100)
    assert hl7_stream.ledgered_table(spark, f"{tmp_path}/out", "ledger").collect() == before
    each_message_once(spark, tmp_path, messages)
