"""Connected components by alternating stars; few edges are joined in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.staging import staged


#: So many edges (3 MB) are few. Beyond that no task sees more than its share of them.
FEW = 200_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find whose roots are the least nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())],
        names=["node", "component"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the larger (or the smaller and own) neighbours of each node to its least one."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("m"))
    if large:
        moved = both.filter("b > a").join(least, F.col("a") == F.col("node")).select("b", "m")
    else:
        moved = both.filter("b < a").join(least, F.col("a") == F.col("node"))
        moved = moved.select("b", "m").union(least.select("node", "m"))
    return moved.filter("b <> m").select(F.col("m").alias("a"), "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its least node) of all nodes in ``edges`` (longs ``a``, ``b``).

    Each round is written out. A node that a third of all edges share is one row on the side of
    the minima, so its edges can be split among tasks; no list of neighbours is ever gathered.
    """
    now = staged(edges.filter("a <> b").select(F.least("a", "b").alias("a"),
                                               F.greatest("a", "b").alias("b")).distinct(), "edges")
    if now.count() <= FEW:
        return now.coalesce(1).mapInArrow(_joined, "node long, component long")
    sums = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = None
    while True:
        mark = tuple(now.agg(*sums).first())
        if mark == before or not mark[0]:
            break
        before = mark
        now = staged(_star(_star(now, True), False), "stars")
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.union(now.select(F.col("b").alias("node"), F.col("a").alias("component")))
