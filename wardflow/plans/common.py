"""Pieces that several queries share."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(name: str) -> Column:
    """Neither NULL nor empty."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def missing(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def percent(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, NULL over no rows."""
    exact = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(exact, 1).cast("double")


def count_by(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def top_groups(df: DataFrame, keys: list[str], name: str, n: int) -> DataFrame:
    """The ``n`` largest groups; equal ones in the order of their keys."""
    return count_by(df, keys, name).orderBy(F.desc(name), *keys).limit(int(n))


def labelled_counts(tables: Mapping[tuple[str, ...], DataFrame], labels: list[str]) -> DataFrame:
    """Row count of each table, one row per table. Reads no columns of them."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(
            *[F.lit(value).alias(label) for label, value in zip(labels, values)], "rows"
        )
        for values, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def optional_facility_filter(df: DataFrame, facility: str | None = None) -> DataFrame:
    """Rows of one facility, or all rows for None and for "All"."""
    if facility is None or facility == "All":
        return df
    return df.where(F.col("facility") == F.lit(facility))
