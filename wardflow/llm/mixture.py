"""Mixing sources to target weights.

Tokens are aggregated per source, each source gets a repetition rate, and every document is
emitted floor(rate) times plus once more when a hash of its id, seen as a number in [0, 1), is
below the fraction of the rate. Where ids are NULL or repeated, texts are hashed along with the
ids, so that documents without an id of their own are drawn one by one. Only DataFrame functions;
the hash makes reruns agree.

Defined cases: a NULL text has size 0; NULL is a source of its own, the last one; a source of size
0 has target 0 and is not emitted; rows that repeat both id and text share a draw; an empty table
gives an empty result. Only the named columns are used, others pass through ``mix`` untouched,
whatever their names: where one is called ``copy``, the number of the copy is ``copy_1``, and so on.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wardflow.llm.staging import staged, word_count

WEIGHTS = (5, 2, 1)


def ranked_sources(totals: DataFrame) -> DataFrame:
    """``rank`` from 0 by code point, NULL last, without bringing all sources into one task.

    Sources are range-partitioned; each is numbered within its partition, and the partitions'
    counts, of which there are only as many as partitions, give the offsets.
    """
    order = F.col("source").asc_nulls_last()
    parts = staged(totals.repartitionByRange(order).withColumn("part", F.spark_partition_id()),
                   "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy("part").agg(F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return (parts.withColumn("place", within).join(offsets, "part")
            .select("source", "source_size", (F.col("place") + F.col("offset") - 1).alias("rank")))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Per source: ``source_size``, ``target`` and ``rate`` from rows of ``source`` and ``size``.

    Sources take ``weights`` in turn and share ``share`` times all sizes. What a source would get
    beyond ``most`` times its size is shared anew by weight among the others until none is above:
    each target is the smaller of its cap and weight times a common level. The level is found by
    a few aggregates over the per-source table; one row of sums comes to the driver each time.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    plan = staged(ranked_sources(totals).select(
        "source", "source_size", weight.alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("cap")), "plan")
    total = plan.agg(F.sum("source_size")).first()[0] or 0
    level, capped_before = float("inf"), -1
    while total:
        capped = F.col("cap") < F.col("weight") * F.lit(level) if capped_before >= 0 else F.lit(False)
        held, free, count = plan.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
            F.sum(capped.cast("int"))).first()
        if count == capped_before or not free:
            break
        level, capped_before = (share * total - held) / free, count
    target = F.least("cap", F.col("weight") * F.lit(level if total else 0.0))
    return plan.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0))


def draw(identifier: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(rate: Column, identifier: Column, seed: int = 0) -> Column:
    """floor(rate), and one more with probability equal to the fraction."""
    extra = (draw(identifier, seed) < rate - F.floor(rate)).cast("int")
    return (F.floor(rate) + extra).cast("int")


def drawn_by(documents: DataFrame) -> Column:
    """What a document's draw is made from: its id, and its text too if ids don't tell rows apart."""
    identifier = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows, different = documents.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if rows == different:
        return identifier
    return F.concat(identifier, F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def mixed_sizes(documents: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    sizes = staged(documents.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                    drawn_by(documents).alias("drawn_by")), "sizes")
    plan = source_targets(sizes).withColumnRenamed("source", "of")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("of")))
    taken = F.col("size") * copies(F.col("rate"), F.col("drawn_by"), seed)
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
        most: float = 2.0, seed: int = 0) -> DataFrame:
    """The mixture itself: each document as often as it is taken, numbered by ``copy`` from 1."""
    sizes = documents.select("source", word_count(F.col("text")).alias("size"))
    plan = source_targets(sizes, weights, share, most).select(F.col("source").alias("of"), "rate")
    # The columns of a document travel in one struct, so that they can't clash with those of here.
    packed = documents.select(F.struct("*").alias("document"), F.col("source").alias("source"),
                              drawn_by(documents).alias("drawn_by"))
    times = copies(F.col("rate"), F.col("drawn_by"), seed)
    given = {name.lower() for name in documents.columns}
    number = "copy" if "copy" not in given else next(
        f"copy_{n}" for n in count(1) if f"copy_{n}" not in given)
    return (packed.join(plan, F.col("source").eqNullSafe(F.col("of")))
            .select("document", times.alias("times")).filter("times > 0")
            .select("document.*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias(number)))
