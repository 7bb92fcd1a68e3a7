"""Queries across the schemas, and over the audit log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.plans.common import labelled_counts


def q_table_inventory(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows of each table; the keys are schema and table name."""
    counts = labelled_counts(tables, ["schema_name", "table_name"])
    return counts.orderBy("schema_name", "table_name")


def q_records_per_schema(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    counts = labelled_counts(tables, ["schema_name", "table_name"])
    return counts.groupBy("schema_name").agg(F.sum("rows").alias("records")).orderBy("schema_name")


def _newest_first(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("ingested_at"), F.desc("refresh_date"), "target_table")


def q_audit_recent(audit: DataFrame, n: int = 10) -> DataFrame:
    """Newest transfers first. Days alone would leave those of one day in any order."""
    return _newest_first(audit).limit(int(n))


def q_last_ingest(audit: DataFrame) -> DataFrame:
    return _newest_first(audit).limit(1).select("source_table", "row_count", "refresh_date")
