"""Code lookups as a join with the terminology, for many code columns or large code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import vocabulary as v
from wardflow.functions.scalars import code_system


def terminology(spark: SparkSession) -> DataFrame:
    """The code lists as rows (system, code, description)."""
    rows = ", ".join(
        f"({v.sql_text(system)}, {v.sql_text(code)}, {v.sql_text(text)})"
        for system, codes in v.TERMINOLOGY.items()
        for code, text in codes.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(system, code, description)")


# A code list of the caller's own is broadcast up to so many rows (about 20 MB), else shuffled.
BROADCAST_CODES = 200_000


def terminology_enrich(
    df: DataFrame, col: str, system: str | None = None, codes: DataFrame | None = None
) -> DataFrame:
    """Add ``description`` and ``code_system`` for a code column.

    Gives what the scalar functions give, also for unknown codes. Without a ``system`` each code
    goes to the one it belongs to. The terminology has a few dozen fixed rows whatever the data,
    so it is broadcast and ``df`` is not shuffled. ``codes`` (system, code, description) adds
    codes and replaces labels; its size decides between a broadcast and a shuffle. Of several
    labels for a code the first in text order counts.
    """
    known, small = terminology(df.sparkSession), True
    if codes is not None:
        own = codes.groupBy("system", "code").agg(F.min("description").alias("description"))
        small = codes.limit(BROADCAST_CODES + 1).count() <= BROADCAST_CODES
        known = known.join(own, ["system", "code"], "left_anti").unionByName(own)
    lists = known.select(
        F.col("system").alias("_system"),
        F.col("code").alias("_code"),
        F.col("description").alias("_label"),
    )
    code = F.col(col)
    belongs = code_system(code) if system is None else F.lit(system)
    looked_up = F.when(belongs == "hedis", F.upper(code)).otherwise(code)
    fallback = code
    for name, prefix in v.UNKNOWN_PREFIX.items():
        if prefix is not None:
            fallback = F.when(belongs == name, F.concat(F.lit(prefix), code)).otherwise(fallback)
    keyed = df.select("*", belongs.alias("code_system"), looked_up.alias("_key"))
    matched = keyed.join(
        F.broadcast(lists) if small else lists,
        (F.col("_key") == F.col("_code")) & (F.col("code_system") == F.col("_system")),
        "left",
    )
    return matched.select(
        *df.columns,
        F.coalesce("_label", fallback).alias("description"),
        "code_system",
    )
