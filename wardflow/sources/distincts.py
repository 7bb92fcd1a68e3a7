"""Exact distinct counts kept up load by load, so that a tile never reads old rows again.

A store numbers every value of a counted column when it first comes, and keeps, per load, bitmaps of
the numbers that the load holds. Distinct counts of any loads together, and of any coarser grouping,
are counts of bits after an OR. A dictionary entry's number is dense within the column and one of
``PARTS`` hash parts, so numbers are dealt without a single task that sees all values.

The ledger has a row per load, written last: what a load that died left behind is never read, and a
load that comes again is passed over. ``merge_loads`` folds all loads into one set of bitmaps. One
writer at a time may use a store. Values are compared as text, NULL is not counted, rows of a NULL
group are a group. Nothing is ever taken out of a count.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

PARTS = 64
VALUES = "name string, value string, part int, number long"
LEDGER = "sequence long, load string, place string, merged boolean"


class DistinctStore:
    """Counts of ``columns`` below ``path``, apart for each group of the ``by`` columns."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str],
                 by: DataFrame | None = None, parts: int = PARTS) -> None:
        """``by`` is a frame whose columns are the groups' names and types; its rows don't count."""
        self.spark, self.path, self.columns, self.parts = spark, path, list(columns), parts
        self.by = list(by.schema.fields) if by is not None else []
        if clash := {"name", "value", "part", "number", "bucket", "bits", "rows"} & set(self.groups):
            raise ValueError(f"name these groups otherwise: {sorted(clash)}")

    @property
    def groups(self) -> list[str]:
        return [field.name for field in self.by]

    def ledger(self) -> DataFrame:
        """All committed loads in order."""
        place = f"{self.path}/ledger"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(place)

    def _read(self, kind: str, schema: StructType | str, places: list[str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{place}/{kind}" for place in places])

    def _bitmaps(self, places: list[str]) -> DataFrame:
        kinds = StructType.fromDDL("name string, part int, bucket long, bits binary").fields
        return self._read("bitmaps", StructType([*self.by, *kinds]), places)

    def _rows(self, places: list[str]) -> DataFrame:
        return self._read("rows", StructType([*self.by, StructField("rows", LongType())]), places)

    def places(self) -> list[str]:
        """Folders that count: the last merged one and those of later loads."""
        committed = self.ledger().orderBy("sequence").collect()
        last = max((i for i, row in enumerate(committed) if row["merged"]), default=0)
        return [row["place"] for row in committed[last:]]

    def _commit(self, load: str | None, place: str, merged: bool) -> None:
        sequence = self.ledger().agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0] + 1
        row = self.spark.createDataFrame([(sequence, load, place, merged)], LEDGER)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")

    def add_load(self, load: str, rows: DataFrame) -> bool:
        """Count the rows of one load; False if a load of that name is in already.

        ``rows`` is read once. What is shuffled and joined are its distinct values.
        """
        if not self.ledger().where(F.col("load") == load).isEmpty():
            return False
        place = f"{self.path}/data/{uuid.uuid4().hex}"
        known = self._read("values", VALUES, self.places())
        # An entry without a name counts the rows themselves.
        entries = [F.struct(F.lit(name).cast("string").alias("name"), value.cast("string").alias("value"))
                   for name, value in [(None, F.lit(None)), *((c, F.col(f"`{c}`")) for c in self.columns)]]
        groups = [F.col(f"`{c}`") for c in self.groups]
        (rows.select(*groups, F.explode(F.array(*entries)).alias("entry"))
         .select(*groups, "entry.name", "entry.value").groupBy(*groups, "name", "value")
         .agg(F.count("*").alias("rows")).write.parquet(f"{place}/seen"))
        seen = self.spark.read.parquet(f"{place}/seen")
        (seen.where("name IS NULL").select(*groups, "rows").write.parquet(f"{place}/rows"))
        seen = seen.where("name IS NOT NULL AND value IS NOT NULL").drop("rows")

        part = F.pmod(F.xxhash64("name", "value"), F.lit(self.parts)).cast("int")
        fresh = (seen.select("name", "value").distinct().join(known, ["name", "value"], "left_anti")
                 .withColumn("part", part))
        highest = known.groupBy("name", "part").agg(F.max("number").alias("highest"))
        place_in_part = F.row_number().over(Window.partitionBy("name", "part").orderBy("value"))
        (fresh.withColumn("place", place_in_part).join(highest, ["name", "part"], "left")
         .select("name", "value", "part",
                 (F.coalesce("highest", F.lit(0)) + F.col("place")).cast("long").alias("number"))
         .write.parquet(f"{place}/values"))
        numbered = known.unionByName(self._read("values", VALUES, [place]))
        (seen.join(numbered, ["name", "value"])
         .groupBy(*groups, "name", "part", F.expr("bitmap_bucket_number(number)").alias("bucket"))
         .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("bits"))
         .write.parquet(f"{place}/bitmaps"))
        self._commit(load, place, False)
        return True

    def merge_loads(self) -> None:
        """Fold all loads into one folder, so that counts read one bitmap per group and bucket."""
        places = self.places()
        if len(places) < 2:
            return
        place = f"{self.path}/data/{uuid.uuid4().hex}"
        groups = [F.col(f"`{c}`") for c in self.groups]
        self._read("values", VALUES, places).write.parquet(f"{place}/values")
        (self._rows(places).groupBy(*groups).agg(F.sum("rows").alias("rows"))
         .write.parquet(f"{place}/rows"))
        (self._bitmaps(places).groupBy(*groups, "name", "part", "bucket")
         .agg(F.bitmap_or_agg("bits").alias("bits")).write.parquet(f"{place}/bitmaps"))
        self._commit(None, place, True)

    def counts(self, by: Sequence[str] | None = None, rows_name: str = "rows") -> DataFrame:
        """Rows and distinct values of each column, per group of ``by`` (all groups, or fewer).

        Without groups there is one row, of zeros where nothing was loaded.
        """
        names = self.groups if by is None else list(by)
        groups = [F.col(f"`{c}`") for c in names]
        places = self.places()
        bits = (self._bitmaps(places).groupBy(*groups, "name", "part", "bucket")
                .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("found"))
                .select(*groups, "name", "found"))
        totals = self._rows(places).select(
            *groups, F.lit(None).cast("string").alias("name"), F.col("rows").alias("found"))

        def total(of: Column, name: str) -> Column:
            return F.coalesce(F.sum(F.when(of, F.col("found"))), F.lit(0)).alias(name)

        return totals.unionByName(bits).groupBy(*groups).agg(
            total(F.col("name").isNull(), rows_name),
            *[total(F.col("name") == c, c) for c in self.columns])
