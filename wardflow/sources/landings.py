"""What changed in a landing folder since the last load.

A state folder holds the listings of the folder by number, and a ledger of those whose files were
loaded. A new listing is compared with the last one in the ledger, so that a load that fails is
made again, with what has landed in the meantime.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.files import landing_files

#: Paths given to a reader at once.
PATHS_AT_ONCE = 10_000


@dataclass(frozen=True)
class Landing:
    """``changes``: path, length, modificationTime and change (new, changed, vanished)."""

    changes: DataFrame
    number: int
    state: str


def landing_changes(spark: SparkSession, path: str, state: str) -> Landing:
    """List the files below ``path`` and compare them with the last committed listing.

    A file is the same if its path, length and time are. Vanished files have the length and time
    they had. The listing is stored first, so that what is compared is what is committed. One
    load at a time may use a state folder, which must not lie below ``path``.
    """
    last = _last_number(spark, state)
    number = last + 1
    landing_files(spark, path).write.mode("overwrite").parquet(_listing(state, number))
    now = spark.read.parquet(_listing(state, number))
    before = spark.read.schema(now.schema).parquet(_listing(state, last)) if last else now.limit(0)
    both = now.alias("now").join(before.alias("before"), "path", "full_outer")
    same = (F.col("now.length") == F.col("before.length")) & (
        F.col("now.modificationTime") == F.col("before.modificationTime"))
    change = (
        F.when(F.col("before.length").isNull(), "new")
        .when(F.col("now.length").isNull(), "vanished")
        .when(~same, "changed")
    )
    known = [F.coalesce(f"now.{c}", f"before.{c}").alias(c) for c in ("length", "modificationTime")]
    changes = both.select("path", *known, change.alias("change")).where("change IS NOT NULL")
    return Landing(changes, number, state)


def landed_since(
    landing: Landing, read: Callable[[list[str]], DataFrame], at_once: int = PATHS_AT_ONCE
) -> Iterator[DataFrame]:
    """What ``read`` makes of the new and changed files, ``at_once`` paths at a time."""
    paths = landing.changes.where("change IN ('new', 'changed')").select("path")
    held: list[str] = []
    for row in paths.toLocalIterator():
        # Readers take paths as patterns.
        held.append(re.sub(r"([\\\[\]{}*?])", r"\\\1", row["path"]))
        if len(held) == at_once:
            yield read(held)
            held = []
    if held:
        yield read(held)


def commit_landing(landing: Landing) -> None:
    """Make this listing the one that the next is compared with. Call it when its load is done."""
    spark = landing.changes.sparkSession
    row = spark.range(1).select(F.lit(landing.number).alias("number"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").parquet(f"{landing.state}/ledger")


def _listing(state: str, number: int) -> str:
    return f"{state}/listing-{number}"


def _last_number(spark: SparkSession, state: str) -> int:
    ledger = f"{state}/ledger"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0
    return spark.read.parquet(ledger).agg(F.max("number")).first()[0]
