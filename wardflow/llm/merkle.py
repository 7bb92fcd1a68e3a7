"""Merkle manifest of a dataset: a digest per row, a tree per source, one tree over the sources.

A row's rank within its source is read as digits of base ``FAN``. Grouping by all digits but the
last one nests the rows of a run, grouping once more nests the runs of a run, and so on: digit
columns are grouped away one after the other, and the digest of each nested struct is taken on the
way. One block nests ``DIGITS`` digits, 4,096 rows; its groupings share one shuffle by block. The
blocks of a source are the nodes of the next block level, until each source has one. ``transform``
goes down a nested block again and ``explode`` emits its rows with the siblings met on the way,
so that no row is joined for its proof; only whole blocks meet the path above them.

Ranks come from a range partitioning and one count per source and partition; no source, however
large, is sorted in one task, and blocks are equally large whatever the source.

Defined cases: NULL is a source of its own, the first one; rows come by id, NULL ids first, equal
ids by their digests, so repeated rows are leaves side by side; NULL values are told from empty
ones; an empty table gives no rows and has no root. Only the named columns are read, and columns
to carry along are kept in a struct, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wardflow.llm.staging import ascii_lower, let, staged

#: Children per node, and digits nested into one block.
FAN, DIGITS = 16, 3
SPAN = FAN**DIGITS
#: Characters of a digest.
WIDTH = 64


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts in lowercase hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*values: Column) -> Column:
    return digest(*[encoded(v) for v in values])


def ranked(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` from 0 within their group (NULL is one), and the group's ``size``.

    The rows are staged first, so that sampling for the ranges doesn't compute them twice, and
    numbered, so that rows equal in ``order`` are dealt out as well.
    """
    numbered = staged(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    by = [F.col(group).asc_nulls_first(), *order, F.col("_tie")]
    placed = staged(numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
                    .withColumn("_place", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_place", 33)
    along = Window.partitionBy("_group").orderBy("_part")
    runs = staged(
        placed.groupBy(F.col(group).alias("_group"), part.alias("_part"))
        .agg(F.count("*").alias("n"), F.min("_place").alias("_first"))
        .select("_group", "_part", "_first",
                F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("_before"),
                F.sum("n").over(Window.partitionBy("_group")).alias("size")), "runs")
    met = placed.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part")))
    return met.select(*rows.columns, "size",
                      (F.col("_place") - F.col("_first") + F.col("_before")).alias("rank"))


def _run(kids: Column) -> Column:
    """The digests of a run, one after the other."""
    return F.array_join(F.transform(kids, lambda kid: kid["hash"]), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block: ``group, block, size, hash`` and nested ``kids``.

    ``nodes`` has ``group, rank, size, hash, carried``. A run is hashed while its group has several
    nodes on that level; a lone node goes up as it is.
    """
    digit = [F.shiftright("rank", 4 * i).bitwiseAND(FAN - 1).alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select("group", "size", F.shiftright("rank", 4 * DIGITS).alias("block"), *digit,
                        "hash", F.col("carried").alias("kids")).repartition("group", "block")
    for level in range(DIGITS):
        above = [f"d{i}" for i in range(level + 1, DIGITS)]
        kid = F.struct(F.col(f"d{level}").alias("digit"), "hash", "kids")
        rows = rows.groupBy("group", "block", "size", *above).agg(
            F.sort_array(F.collect_list(kid)).alias("kids"))
        several = F.col("size") > FAN**level
        rows = rows.withColumn("hash", F.when(several, digest(_run(F.col("kids"))))
                               .otherwise(F.get("kids", F.lit(0))["hash"]))
    return rows


def _forest(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of all levels, the last one with a single block per group."""
    levels = []
    while True:
        levels.append(staged(_blocks(nodes), "blocks"))
        most = levels[-1].agg(F.max("size")).first()[0] or 0
        if most <= SPAN:
            return levels
        nodes = levels[-1].select(
            "group", F.col("block").alias("rank"),
            F.ceil(F.col("size") / SPAN).alias("size"), "hash", F.lit(0).alias("carried"))


def _step(run: Column, digit: Column, several: Column) -> Column:
    """The siblings before and after a child; NULL where its level wasn't hashed."""
    at = digit * WIDTH
    return F.when(several, F.struct(F.substr(run, F.lit(1), at).alias("before"),
                                    F.substr(run, at + WIDTH + 1).alias("after")))


def _emitted(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Per node: ``group, rank, hash, carried, tops`` and its ``path``, lowest level first.

    ``above`` has ``group, rank, path, tops`` for each block; it has one row where blocks have
    4,096 nodes, and is written first, so that Spark knows its size when it chooses the join.
    """
    several = [F.col("size") > FAN**i for i in range(DIGITS)]

    def node(k0: Column, k1: Column, k2: Column, runs: tuple[Column, ...]) -> Column:
        steps = F.array(*[_step(run, kid["digit"], many)
                          for run, kid, many in zip(runs, (k0, k1, k2), several)])
        within = k0["digit"] + FAN * k1["digit"] + FAN**2 * k2["digit"]
        return F.struct(within.alias("within"), k0["hash"].alias("hash"),
                        k0["kids"].alias("carried"),
                        F.filter(steps, lambda s: s.isNotNull()).alias("path"))

    def of_run(k1: Column, k2: Column, *runs: Column) -> Column:
        return let(_run(k1["kids"]), lambda run: F.transform(
            k1["kids"], lambda k0: node(k0, k1, k2, (run, *runs))))

    def of_runs(k2: Column, top: Column) -> Column:
        return let(_run(k2["kids"]), lambda run: F.flatten(F.transform(
            k2["kids"], lambda k1: of_run(k1, k2, run, top))))

    every = let(_run(F.col("kids")), lambda top: F.flatten(F.transform(
        "kids", lambda k2: of_runs(k2, top))))
    over = staged(above, "above").select(F.col("group").alias("_group"), F.col("rank").alias("_rank"),
                                         F.col("path").alias("_path"), "tops")
    met = blocks.join(over, F.col("group").eqNullSafe(F.col("_group"))
                      & (F.col("block") == F.col("_rank")))
    return met.select("group", "block", "_path", "tops", F.explode(every).alias("node")).select(
        "group", (F.col("block") * SPAN + F.col("node.within")).alias("rank"), "node.hash",
        "node.carried", "tops", F.concat("node.path", "_path").alias("path"))


def manifest(leaves: DataFrame, source: str = "source", identifier: str = "doc_id",
             leaf: str = "leaf", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per leaf: id, leaf, ``carry``, ``subroot``, ``root`` and ``proof``.

    ``leaves`` needs the source, the id and the digest of each row. ``proof`` lists, from the leaf
    up to the root, the digests of the siblings ``before`` and ``after`` the node on each level,
    64 characters each; ``folded`` follows it.
    """
    kept = leaves.select(F.col(source).alias("group"), F.col(leaf).alias("hash"),
                         F.struct(F.col(identifier).alias("id"),
                                  F.struct(F.lit(0).alias("_"), *carry).alias("more")).alias("carried"))
    within = _forest(ranked(kept, "group", [F.col("carried.id").asc_nulls_first(), F.col("hash")]))
    subroots = within[-1].select(F.col("group").alias("source"), "hash")
    over = _forest(ranked(subroots.withColumn("all", F.lit(0)), "all",
                          [F.col("source").asc_nulls_first()])
                   .select(F.col("all").alias("group"), "rank", "size", "hash",
                           F.struct("source").alias("carried")))
    no_path = F.array().cast("array<struct<before:string,after:string>>")
    above = over[-1].select("group", F.lit(0).cast("long").alias("rank"), no_path.alias("path"),
                            F.struct(F.col("hash").alias("root")).alias("tops"))
    for blocks in reversed(over):
        above = _emitted(blocks, above)
    above = above.select(
        F.col("carried.source").alias("group"), F.lit(0).cast("long").alias("rank"), "path",
        F.struct(F.col("hash").alias("subroot"), F.col("tops.root").alias("root")).alias("tops"))
    for blocks in reversed(within):
        above = _emitted(blocks, above)
    return above.select(
        F.col("carried.id").alias(identifier), F.col("hash").alias(leaf),
        *[F.col(f"carried.more.`{c}`") for c in carry], "tops.subroot", "tops.root",
        F.col("path").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def document_leaves(documents: DataFrame) -> DataFrame:
    """``source, doc_id``, the ``leaf`` over all five columns, and a ``tampered`` leaf.

    The latter is that of the same row with A to Z of its text lower-cased, for the fifth of
    documents whose id's CRC-32 is divisible by 5, and NULL for the others.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return documents.select(
        "source", "doc_id", leaf_digest(*columns, F.col("text")).alias("leaf"),
        F.when(chosen, leaf_digest(*columns, ascii_lower(F.col("text")))).alias("tampered"))


def verified_documents(documents: DataFrame) -> DataFrame:
    """Every document's leaf, roots, proof, and whether its possibly tampered row verifies."""
    proofs = manifest(document_leaves(documents), carry=("tampered",))
    seen = proofs.select(
        "*", folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return seen.drop("tampered").withColumn("verified", F.col("folded_root") == F.col("root"))
