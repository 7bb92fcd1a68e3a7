"""Managed tables take little disk, and whole resources are written without inferring a layout."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from wardflow.operators import fhir
from wardflow.sources import tables


def on_disk(folder):
    return sum(os.path.getsize(path) for path in glob.glob(f"{folder}/**/part-*", recursive=True))


@pytest.fixture
def database(spark, tmp_path):
    name = f"files_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name


@pytest.mark.parametrize("times", [1, 2])
def test_tables_are_smaller_than_files_of_the_default_kind(spark, tmp_path, database, times):
    rows = spark.range(50_000, numPartitions=1).select(F.concat(F.lit("e"), "id").alias("id"), F.md5(
        (F.col("id") % 5000).cast("string")).alias("text"))
    rows.write.option("compression", "snappy").parquet(f"{tmp_path}/default")
    for _ in range(times):  # the first load makes the table, later ones point it at new files
        tables.table_overwrite_sink(rows, f"{database}.texts")
    stored = spark.table(f"{database}.texts")
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()
    newest = os.path.dirname(stored.inputFiles()[0]).removeprefix("file:").removeprefix("//")
    assert on_disk(newest) < 0.8 * on_disk(f"{tmp_path}/default")


def test_whole_resources_are_stored_without_an_inferred_layout(spark, database):
    text = '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Patient","id":"p","x":{"y":[1,2]}}}]}'
    resources = fhir.fhir_resources(spark.createDataFrame([(text,)] * 100, "value string"))
    tables.table_overwrite_sink(resources, f"{database}.resources")
    stored = spark.table(f"{database}.resources")
    assert {tuple(r) for r in stored.select("id", fhir.resource_field("$.x.y[1]", "int")).collect()} == {("p", 2)}
    import pyarrow.parquet as parquet
    path = stored.inputFiles()[0].removeprefix("file:").removeprefix("//")
    names = [field.path for field in map(parquet.ParquetFile(path).schema.column, range(
        len(parquet.ParquetFile(path).schema)))]
    assert "resource.value" in names and not any("typed_value" in name for name in names)
