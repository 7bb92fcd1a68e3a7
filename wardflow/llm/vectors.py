"""Embedding near-dedup by NN-descent.

Equal vectors are one class first. The neighbour graph starts from the vectors' order along
``ORDERS`` random sign codes and is refined by joining neighbours of neighbours: each vector's
neighbours and reverse neighbours are compared with each other, pairs that were compared before
excepted, and each keeps the best ``NEIGHBOURS``. Edges at the threshold are confirmed in double
precision and joined into components. Vectors whose list is full of links may have more: all members
of their components are compared with those of the other such components of the label, by tiles,
where only tiles too far apart for any link, by their centres and radii, are passed over.
Links are then counted within each component by tiles of ``TILE`` vectors, without a row per pair.
An audit compares a sample with all rows, until enough vectors with few links and with many are held;
where the mean share of their links that was found is below ``RECALL`` for either kind, everything is
done again with twice the neighbours and turns. What misses the bar at the end, or was held by too few
vectors to tell, is reported by a warning.

Defined cases: vectors that are NULL, zero or hold NULL or non-finite components, and those with a
NULL label, link with nothing; vectors of different length do not link; rows that repeat an id are
separate rows; copies link with each other without being paired; ties are broken by key; an empty
table gives no rows; columns other than the three named are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import graph
from wardflow.llm.staging import bounded_batches, keyed, staged

THRESHOLD, NEIGHBOURS, ORDERS, ALONG, TURNS, TILE = 0.93, 12, 6, 4, 5, 2048
#: Share of changed list entries below which the graph counts as settled.
SETTLED = 0.005
#: Vectors in the audit's first sample (at most 0.5 MB each at 65,536 components) and the recall it asks for.
AUDITED, RECALL = 256, 0.97
#: Vectors of a kind that the audit wants to hold, and bytes of vectors at which its sample stops growing.
HELD, AUDIT_BYTES = 128, 8 << 20
#: Rows that are compared with the sample at once.
PART = 256
#: Growth of neighbours and turns beyond which a low recall is reported instead.
GROWTH = 8
#: Radians by which tiles are taken to be nearer than computed, far more than rounding adds.
SLACK = 1e-6


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for values in batch.column("embedding"):
            x = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
            x = x / np.abs(x).max()
            rows.append((x / np.sqrt(x @ x)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("grp"),
                                          pa.array(rows, pa.binary())], names=["key", "grp", "unit"])


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """``key, grp, unit`` (doubles as bytes) of the vectors that may link."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    grp = F.concat_ws(":", F.size("embedding").cast("string"), F.col("label").cast("string"))
    return (embeddings.filter("label IS NOT NULL AND embedding IS NOT NULL").filter(usable)
            .select("key", grp.alias("grp"), "embedding")
            .mapInArrow(_units, "key long, grp string, unit binary"))


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column])


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector once per order, with the sign code that places it there."""
    for batch in batches:
        if not batch.num_rows:
            continue
        units = batch.column("unit").to_pylist()
        sizes = np.array([len(u) // 8 for u in units])
        code = np.zeros((len(units), ORDERS), np.int64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            planes = np.random.default_rng(int(size)).standard_normal((int(size), ORDERS * 24))
            signs = (_matrix([units[i] for i in rows]) @ planes > 0).reshape(len(rows), ORDERS, 24)
            code[rows] = signs @ (1 << np.arange(23, -1, -1))
        grp, keys = batch.column("grp").to_pylist(), batch.column("key").to_pylist()
        small = [np.frombuffer(u, np.float64).astype(np.float32).tobytes() for u in units]
        for order in range(ORDERS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{order}:{g}" for g in grp]), pa.array(code[:, order]),
                 pa.array(keys, pa.int64()), pa.array(small, pa.binary())],
                names=["place", "code", "key", "small"])


PROPOSED = "node long, other long, sim float"


def _proposals(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    node, other, sim = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()),
                                       pa.array(sim, pa.float32())], names=["node", "other", "sim"])


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of vectors that follow each other in an order; both directions."""
    last: list[tuple] = []
    for batch in batches:
        rows, every = [], list(last)
        every += zip(batch.column("place").to_pylist(), batch.column("key").to_pylist(),
                     [np.frombuffer(x, np.float32) for x in batch.column("small").to_pylist()])
        for i in range(len(last), len(every)):
            for j in range(max(0, i - ALONG), i):
                if every[i][0] == every[j][0]:
                    sim = float(every[i][2] @ every[j][2])
                    rows += [(every[i][1], every[j][1], sim), (every[j][1], every[i][1], sim)]
        last = every[-ALONG:]
        yield _proposals(rows)


def _met(most: int):
    """Neighbours of the same vector, compared with each other; each proposes its best ones."""

    def local(rows: list[tuple], out: list) -> None:
        keys = np.array([r[1] for r in rows])
        fresh = np.array([r[2] for r in rows])
        every = np.stack([np.frombuffer(r[3], np.float32) for r in rows])
        sims = every @ every.T
        sims[~(fresh[:, None] | fresh[None, :])] = -2
        np.fill_diagonal(sims, -2)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :most]
        for i, row in enumerate(best):
            out += [(int(keys[i]), int(keys[j]), float(sims[i, j])) for j in row if sims[i, j] > -2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            out: list = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("center", "key", "fresh", "small"))):
                if group and group[0][0] != row[0]:
                    local(group, out)
                    group = []
                group.append(row)
            yield _proposals(out)
        if group:
            out = []
            local(group, out)
            yield _proposals(out)

    return run


def _best(proposed: DataFrame, most: int) -> DataFrame:
    """The best entries of each list. Spark drops all but these before the shuffle."""
    distinct = proposed.groupBy("node", "other").agg(
        F.max("sim").alias("sim"), F.max("old").alias("old"))
    order = Window.partitionBy("node").orderBy(F.col("sim").desc(), "other")
    return distinct.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most).drop("n")


def descended(units: DataFrame, neighbours: int = NEIGHBOURS, turns: int = TURNS) -> DataFrame:
    """``node, other, sim, old`` of the neighbour graph over ``key, grp, unit``."""
    placed = staged(units.mapInArrow(_codes, "place string, code long, key long, small binary"),
                    "placed")
    small = placed.filter(F.col("place").startswith("0:")).select("key", "small")
    sorted_ = placed.repartitionByRange("place", "code", "key").sortWithinPartitions(
        "place", "code", "key")
    lists = staged(_best(sorted_.mapInArrow(_along, PROPOSED).withColumn("old", F.lit(0)),
                         neighbours), "lists")
    total = lists.count()
    some = Window.partitionBy("center").orderBy(F.xxhash64("center", "key"), "key")
    for turn in range(turns):
        forward = lists.select(F.col("node").alias("center"), F.col("other").alias("key"),
                               (F.col("old") == 0).alias("fresh"))
        back = (lists.select(F.col("other").alias("center"), F.col("node").alias("key"),
                             (F.col("old") == 0).alias("fresh"))
                .withColumn("n", F.row_number().over(some)).filter(F.col("n") <= neighbours)
                .drop("n"))
        around = forward.unionByName(back).groupBy("center", "key").agg(
            F.max("fresh").alias("fresh"))
        proposed = (around.join(small, "key").select("center", "key", "fresh", "small")
                    .repartition("center").sortWithinPartitions("center", "key")
                    .mapInArrow(_met(max(3, neighbours // 3)), PROPOSED))
        lists = staged(_best(lists.select("node", "other", "sim", F.lit(1).alias("old")).unionByName(
            proposed.withColumn("old", F.lit(0))), neighbours), f"lists-{turn}")
        if lists.filter("old = 0").count() <= SETTLED * total:
            break
    return lists


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dots = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64))
                for x, y in zip(batch.column("ua").to_pylist(), batch.column("ub").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"),
                                          pa.array(dots, pa.float64())], names=["a", "b", "cosine"])


def threshold_edges(lists: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` of list entries at the threshold, by double-precision cosine."""
    near = (lists.filter(F.col("sim") >= threshold - 0.001)
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct())
    sides = [units.select(F.col("key").alias(x), F.col("unit").alias(f"u{x}")) for x in "ab"]
    return (near.join(sides[0], "a").join(sides[1], "b")
            .mapInArrow(_dots, "a long, b long, cosine double")
            .filter(F.col("cosine") >= threshold).select("a", "b"))


def _balls(pdf: pd.DataFrame) -> pd.DataFrame:
    """Centre of a tile, and the largest angle between it and a vector of the tile."""
    every = _matrix(pdf.unit)
    centre = every.sum(0)
    length = np.sqrt(centre @ centre)
    centre = centre / length if length > SLACK else every[0]
    radius = float(np.arccos(np.clip(every @ centre, -1, 1)).max())
    return pd.DataFrame({"grp": pdf.grp.iloc[:1], "component": pdf.component.iloc[:1], "tile": pdf.tile.iloc[:1],
                         "centre": [centre.tobytes()], "radius": [radius]})


def _near_tiles(threshold: float):
    """Pairs of tiles of different components that are near enough to hold a link."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf.block == pdf.p.iloc[0]], pdf[pdf.block == pdf.q.iloc[0]]
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("ca", "ta", "cb", "tb")})
        angle = np.arccos(np.clip(_matrix(left.centre) @ _matrix(right.centre).T, -1, 1))
        reach = np.arccos(threshold) + left.radius.to_numpy()[:, None] + right.radius.to_numpy()[None, :]
        differ = left.component.to_numpy()[:, None] != right.component.to_numpy()[None, :]
        if pdf.p.iloc[0] == pdf.q.iloc[0]:
            differ &= left.component.to_numpy()[:, None] < right.component.to_numpy()[None, :]
        i, j = np.nonzero(differ & (angle <= reach + SLACK))
        return pd.DataFrame({"ca": left.component.to_numpy()[i], "ta": left.tile.to_numpy()[i].astype("int64"),
                             "cb": right.component.to_numpy()[j], "tb": right.tile.to_numpy()[j].astype("int64")})

    return run


def _bridge(threshold: float):
    """The closest vectors of two tiles, if they link."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["first"]], pdf[~pdf["first"]]
        cosines = _matrix(left.unit) @ _matrix(right.unit).T
        i, j = np.unravel_index(cosines.argmax(), cosines.shape)
        hit = [0] if cosines[i, j] >= threshold else []
        return pd.DataFrame({"a": left.key.to_numpy()[[i]][hit], "b": right.key.to_numpy()[[j]][hit]})

    return run


def bridges(members: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: a link between each two components that have one, from ``component, key, grp, unit``.

    Every pair of vectors is compared unless the tiles they lie in are too far apart.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = staged(members.join(sizes, "component").withColumn("tile", F.pmod(
        F.xxhash64("key"), F.col("tiles")).cast("int")).drop("tiles"), "tiled")
    balls = staged(tiled.groupBy("component", "tile").applyInPandas(
        _balls, "grp string, component long, tile int, centre binary, radius double"), "balls")
    blocks = balls.groupBy("grp").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("component", "tile"), F.col("blocks")).cast("int")
    dealt = (balls.join(blocks, "grp").withColumn("block", block)
             .withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("p", F.least("block", "meets")).withColumn("q", F.greatest("block", "meets")))
    near = staged(dealt.drop("blocks", "meets").groupBy("grp", "p", "q").applyInPandas(
        _near_tiles(threshold), "ca long, ta long, cb long, tb long"), "near")
    sides = [near.select("*", F.lit(first).alias("first"), F.col(f"c{x}").alias("component"),
                         F.col(f"t{x}").cast("int").alias("tile")) for x, first in (("a", True), ("b", False))]
    return (sides[0].unionByName(sides[1]).join(tiled.select("component", "tile", "key", "unit"), ["component", "tile"])
            .groupBy("ca", "ta", "cb", "tb").applyInPandas(_bridge(threshold), "a long, b long"))


def _components(units: DataFrame, neighbours: int, threshold: float, turns: int = TURNS) -> DataFrame:
    """``node, component`` of all vectors with a link; saturated components are compared in full."""
    lists = descended(units, neighbours, turns)
    edges = staged(threshold_edges(lists, units, threshold), "edges")
    found = staged(graph.components(edges), "components")
    full = (lists.filter(F.col("sim") >= threshold - 0.001).groupBy("node").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= neighbours).select("node"))
    saturated = found.join(full, "node", "left_semi").select("component").distinct()
    members = found.join(saturated, "component").join(units, F.col("key") == F.col("node"))
    new = staged(bridges(members.select("component", "key", "grp", "unit"), threshold), "bridges")
    if new.isEmpty():
        return found
    return staged(graph.components(edges.union(new)), "components")


def _tile_links(threshold: float):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf.tile == pdf.p.iloc[0]]
        right = pdf[pdf.tile == pdf.q.iloc[0]]
        same = pdf.p.iloc[0] == pdf.q.iloc[0]
        if not len(left) or not len(right):
            return pd.DataFrame({"key": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64")})
        linked = _matrix(left.unit) @ _matrix(right.unit).T >= threshold
        if same:
            np.fill_diagonal(linked, False)
        parts = [pd.DataFrame({"key": left.key, "links": linked @ right.times.to_numpy()})]
        if not same:
            parts.append(pd.DataFrame({"key": right.key, "links": linked.T @ left.times.to_numpy()}))
        return pd.concat(parts)

    return count


def _links(members: DataFrame, threshold: float) -> DataFrame:
    """``key, links`` from ``component, key, unit, times``; each row meets its component in tiles."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = members.join(sizes, "component").withColumn("tile", F.pmod(
        F.xxhash64("key"), F.col("tiles")).cast("int"))
    dealt = (tiled.withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("p", F.least("tile", "meets")).withColumn("q", F.greatest("tile", "meets")))
    return (dealt.select("component", "p", "q", "tile", "key", "unit", "times")
            .groupBy("component", "p", "q")
            .applyInPandas(_tile_links(threshold), "key long, links long")
            .groupBy("key").agg(F.sum("links").alias("links")))


def _audit_counts(sample: list, threshold: float):
    groups: dict[str, list] = {}
    for row in sample:
        groups.setdefault(row.grp, []).append((row.key, bytes(row.unit)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen = {grp: _matrix([u for _, u in own]) for grp, own in groups.items()}
        for pdf in batches:
            for grp, rows in pdf.groupby("grp"):
                if grp in groups:
                    every, times = _matrix(rows.unit), rows.times.to_numpy()
                    hits = np.zeros(len(groups[grp]), times.dtype)
                    for i in range(0, len(every), PART):
                        hits += (every[i:i + PART] @ chosen[grp].T >= threshold).T @ times[i:i + PART]
                    yield pd.DataFrame({"key": [k for k, _ in groups[grp]], "links": hits})

    return run


def audit(classes: DataFrame, links: DataFrame, threshold: float, sample: int = AUDITED) -> dict:
    """``{kind: (vectors held, mean share of their links found)}``, by comparison with all rows.

    Kinds are vectors with fewer links than a list has entries, and others, so that one large group
    does not speak for all. The sample grows until both kinds hold ``HELD``, all rows are compared,
    or it takes ``AUDIT_BYTES``.
    """
    rows, longest = classes.agg(F.count("*"), F.max(F.length("unit"))).first()
    if not rows:
        return {}
    most = max(sample, AUDIT_BYTES // longest)
    own = classes.select("key", "times")
    share = F.least(F.lit(1.0), F.coalesce("links", F.lit(0)) / (F.col("true") - F.col("times")))
    while True:
        chosen = (classes.orderBy(F.xxhash64(F.lit(1), "key"), "key").limit(sample)
                  .select("key", "grp", "unit").collect())
        true = classes.select("grp", "unit", "times").mapInPandas(
            _audit_counts(chosen, threshold), "key long, links long")
        true = true.groupBy("key").agg((F.sum("links")).alias("true"))
        kinds = (true.join(own, "key").join(links, "key", "left").filter(F.col("true") > F.col("times"))
                 .groupBy(F.when(F.col("true") - F.col("times") < NEIGHBOURS, "few").otherwise("many").alias("kind"))
                 .agg(F.count("*"), F.avg(share)).collect())
        held = {kind: (n, mean) for kind, n, mean in kinds}
        if sample >= min(rows, most) or all(held.get(k, (0,))[0] >= HELD for k in ("few", "many")):
            break
        sample = min(8 * sample, most)
    if sample < rows and sum(n for n, _ in held.values()) < HELD:
        warnings.warn(f"recall of near vectors is uncertain: of {sample} vectors compared with all rows, "
                      f"{sum(n for n, _ in held.values())} have links", RuntimeWarning, stacklevel=2)
    return held


def audited_recall(classes: DataFrame, links: DataFrame, threshold: float,
                   sample: int = AUDITED) -> float:
    """The lowest mean share of a kind of vectors in the audit."""
    return min((mean for _, mean in audit(classes, links, threshold, sample).values()), default=1.0)


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD,
                 neighbours: int = NEIGHBOURS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    rows = keyed(embeddings, "vec_id", "embedding", "label")
    units = staged(unit_vectors(rows), "units")
    classes = staged(units.groupBy("grp", "unit").agg(
        F.min("key").alias("key"), F.count("*").alias("times")), "classes")
    growth = 1
    while True:
        found = _components(classes.select("key", "grp", "unit"), growth * neighbours, threshold, growth * TURNS)
        members = classes.join(found, F.col("key") == F.col("node"))
        links = staged(_links(members.select("component", "key", "unit", "times"), threshold), "links")
        recall = audited_recall(classes, links, threshold)
        if recall >= RECALL:
            break
        if growth >= GROWTH:
            warnings.warn(f"recall of near vectors is {recall:.4f}, below {RECALL}, with lists of "
                          f"{growth * neighbours}", RuntimeWarning, stacklevel=2)
            break
        growth *= 2
    of_class = (classes.select("grp", "unit", F.col("key").alias("rep"), "times")
                .join(found.withColumnRenamed("node", "rep"), "rep", "left")
                .join(links.withColumnRenamed("key", "rep"), "rep", "left")
                .select("grp", "unit", F.coalesce("component", "rep").alias("component"),
                        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links")))
    named = rows.select("key", "vec_id").join(
        units.join(of_class, ["grp", "unit"]).select("key", "component", "n_links"), "key", "left")
    least = (named.filter("component IS NOT NULL").groupBy("component")
             .agg(F.min("vec_id").alias("least")))
    out = named.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      component.eqNullSafe(F.col("vec_id")).alias("kept"))
