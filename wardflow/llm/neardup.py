"""MinHash near-dedup by an inverted join over signature coordinates.

Every distinct shingle set gets a signature of ``COORDINATES`` minima. Documents are posted under
their coordinate-value pairs. Two sets that are similar enough agree in ``needed`` coordinates or
more (but for one case in 100,000 right at the threshold), so they meet under a pair among the
``COORDINATES - needed + 1`` rarest of each: only this prefix is posted, pairs that no other set
has are left out at once, and the long lists of frequent pairs are skipped. Collisions of the
candidates are then counted on their signatures, and those with enough are confirmed on the full
sets.

Lists are merged without a row per pair. At first a list is compared with ``CHOSEN`` of its members,
and what is confirmed is joined into components; lists within one component are done. The longer ones of the rest overlap much, so each document first takes its
longest open list as its home and is compared with the others at home; a list whose members share
a home is done. Whatever is still open is compared in full. Both go by tiles of ``TILE`` documents
whose full sets a task intersects at once, and from which only a forest of links comes out.

Defined cases: NULL text and text without words have an empty set and link with nothing; with fewer
words than a shingle has, the whole sequence is the one shingle; equal sets are one class from the
start, so copies are never paired; rows that repeat an id are separate rows of equal id; ties do
not matter, as the least id names a component; an empty table gives no rows; columns other than
the two named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import graph, words
from wardflow.llm.staging import bounded_batches, frugal, keyed, staged
from wardflow.llm.substrings import _binary

COORDINATES, MISSED, CHOSEN, HOMES = 32, 1e-5, 2, 2
#: Documents of a tile, and the shingles it may hold (16 MB) if there is more than one of them.
TILE, TILE_SHINGLES, COLUMNS = 512, 2_000_000, 4096
_random = np.random.default_rng(271828)
_factor = _random.integers(0, 1 << 63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_offset = _random.integers(0, 1 << 63, 128, dtype=np.uint64)
SETS = "key long, doc_id long, n_shingles long, one long, two long, signature array<int>"
_SETS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                   ("one", pa.int64()), ("two", pa.int64()), ("signature", pa.list_(pa.int32()))])


def needed_matches(threshold: float, coordinates: int = COORDINATES, missed: float = MISSED) -> int:
    """The largest number of agreeing coordinates that sets at the threshold fall short of rarely."""
    total = 0.0
    for n in range(coordinates + 1):
        total += math.comb(coordinates, n) * threshold ** n * (1 - threshold) ** (coordinates - n)
        if total > missed:
            return max(1, n)
    return coordinates


def _shingles(texts: list[bytes | None], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Index of each text with words, and its sorted set of shingle hashes."""
    for first, counts, hashes in words.hashed(texts, lower=True):
        found, at = words.windows(hashes, size), 0
        for i, count in enumerate(counts.tolist()):
            if count >= size:
                yield first + i, np.unique(found[at:at + count - size + 1])
            elif count:
                yield first + i, words.windows(hashes[at:at + count], count)
            at += count


def _signed(size: int, coordinates: int):
    def batch_of(rows: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        minima = np.stack([np.minimum.reduceat((every * _factor[k] + _offset[k]) >> np.uint64(32),
                                               starts)
                           for k in range(coordinates)], axis=1).astype(np.uint32).view(np.int32)
        one = np.add.reduceat(words.mixed(every), starts).view(np.int64)
        two = np.add.reduceat(words.mixed(every ^ np.uint64(0x5851F42D4C957F2D)), starts)
        keys, ids = zip(*rows)
        offsets = np.arange(0, minima.size + 1, coordinates, dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array(one),
             pa.array(two.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(minima.ravel()))], schema=_SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("doc_id").to_pylist()
            empty = set(range(len(keys)))
            rows, sets, size_now = [], [], 0
            for i, members in _shingles(_binary(batch.column("text")), size):
                empty.discard(i)
                rows.append((keys[i], ids[i]))
                sets.append(members)
                size_now += len(members)
                if size_now > 400_000:
                    yield batch_of(rows, sets)
                    rows, sets, size_now = [], [], 0
            if rows:
                yield batch_of(rows, sets)
            if empty:
                yield pa.RecordBatch.from_pylist(
                    [{"key": keys[i], "doc_id": ids[i], "n_shingles": 0} for i in sorted(empty)],
                    schema=_SETS)

    return run


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, held = batch.column("key").to_pylist(), [], 0
            for i, members in _shingles(_binary(batch.column("text")), size):
                rows.append((keys[i], members.tobytes()))
                held += len(rows[-1][1])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()),
                         pa.array([r[1] for r in rows], pa.binary())], names=["key", "members"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["key", "members"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            good = []
            for i, (x, y) in enumerate(zip(batch.column("of_a"), batch.column("of_b"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in good], pa.int64()),
                 pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])

    return run


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices of the shingles met twice."""
    every, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    met = times[inverse] > 1
    of, column = of[met], (np.cumsum(times > 1) - 1)[inverse[met]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    for first in range(0, int((times > 1).sum()), COLUMNS):
        at, to = np.searchsorted(column, (first, first + COLUMNS))
        inside = np.zeros((len(sets), COLUMNS), np.float32)
        inside[of[at:to], column[at:to] - first] = 1
        shared += inside @ inside.T
    return shared


def _forest(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links of a tile as ``(key, least key index that it reaches)``."""
    keys = [r[0] for r in rows]
    component = np.array([r[1] for r in rows])
    if (component == component[0]).all():
        return []
    sets = [np.frombuffer(r[2], np.uint64) for r in rows]
    size, shared = np.array([len(x) for x in sets]), _shared_counts(sets)
    linked = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
    linked &= component[:, None] != component[None, :]
    if not linked.any():
        return []
    least = np.arange(len(rows))
    while True:
        new = np.minimum(least, np.where(linked, least[None, :], len(rows)).min(1))
        new = new[new]
        if (new == least).all():
            return [(keys[i], keys[to]) for i, to in enumerate(least) if i != to]
        least = new


def _tiled(percent: int):
    """Rows come sorted by list and tiles; each pair of tiles is compared once it is complete."""

    def batch_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            links: list[tuple[int, int]] = []
            for pair, p, q, *row in zip(*(batch.column(c).to_pylist() for c in (
                    "pair", "p", "q", "key", "component", "members"))):
                if (pair, p, q) != now and rows:
                    links += _forest(rows, percent)
                    rows = []
                now = (pair, p, q)
                rows.append(row)
            yield batch_of(links)
        if rows:
            yield batch_of(_forest(rows, percent))

    return run


class _Lists:
    """Posted prefixes of the classes and what comparing members of a list needs."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int,
                 coordinates: int) -> None:
        self.percent, self.needed = percent, needed_matches(percent / 100, coordinates)
        pairs = classes.select("key", F.posexplode("signature").alias("coordinate", "value")).select(
            "key", F.xxhash64("coordinate", "value").alias("pair"))
        often = pairs.groupBy("pair").agg(F.count("*").alias("n")).filter("n > 1")
        shared = pairs.join(often, "pair").groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("pairs"))
        prefix = coordinates - self.needed + 1
        posted = F.slice("pairs", 1, F.greatest(
            F.lit(0), F.lit(prefix - coordinates) + F.size("pairs")))
        self.postings = staged(shared.select("key", F.explode(posted).alias("pair"))
                               .select("key", "pair.pair"), "postings")
        wanted = self.postings.select("key").distinct()
        self.signatures = staged(classes.join(wanted, "key").select(
            "key", "n_shingles", "signature"), "signatures")
        self.sets = staged(docs.join(wanted, "key", "left_semi").select("key", "text").mapInArrow(
            frugal(_set_rows(size)), "key long, members binary"), "sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that have enough collisions and are similar enough in full."""
        side = [self.signatures.select(F.col("key").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                       F.col("signature").alias(f"s_{x}")) for x in "ab"]
        agree = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: (x == y).cast("int")), F.lit(0),
                            lambda n, x: n + x)
        alike = (pairs.join(side[0], "a").join(side[1], "b")
                 .filter(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
                 .filter(agree >= self.needed).select("a", "b"))
        members = [self.sets.select(F.col("key").alias(x), F.col("members").alias(f"of_{x}"))
                   for x in "ab"]
        return (alike.join(members[0], "a").join(members[1], "b")
                .mapInArrow(frugal(_confirmed(self.percent)), "a long, b long"))


    def tile_links(self, members: DataFrame) -> DataFrame:
        """Links within each list of ``pair, key, component``, between different components."""
        sized = members.join(self.signatures.select("key", "n_shingles"), "key")
        tiles = sized.groupBy("pair").agg(F.greatest(
            F.ceil(F.count("*") / TILE), F.ceil(F.sum("n_shingles") / TILE_SHINGLES))
            .cast("int").alias("tiles"))
        tile = F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
        dealt = (members.join(tiles, "pair").withColumn("tile", tile)
                 .withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
                 .select("pair", F.least("tile", "meets").alias("p"),
                         F.greatest("tile", "meets").alias("q"), "key", "component"))
        return (dealt.join(self.sets, "key").repartition("pair", "p", "q")
                .sortWithinPartitions("pair", "p", "q", "key")
                .mapInArrow(frugal(_tiled(self.percent)), "a long, b long"))


def _mixed(lists: DataFrame) -> DataFrame:
    """Lists (``pair``) of more than one component, and their length."""
    return (lists.groupBy("pair")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                 F.count("*").alias("n")).filter("low <> high").select("pair", "n"))


def _at_home(lists: DataFrame, homes: int) -> DataFrame:
    """Lists whose members all had the same home in some round."""
    same = F.lit(False)
    for i in range(homes):
        same = same | ((F.min(f"home{i}") == F.max(f"home{i}"))
                       & (F.count(f"home{i}") == F.count("*")))
    return lists.groupBy("pair").agg(same.alias("same")).filter("same").select("pair")


def _linked(lists: _Lists) -> DataFrame:
    """``node, component`` over the classes that link with another."""
    links = lists.postings.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    now, homes = lists.postings.withColumn("component", F.col("key")), 0
    for turn in range(HOMES + 2):
        # Lists of two were compared in full by the first round.
        mixed = _mixed(now).filter(F.col("n") > (2 if turn else 1))
        if homes:
            mixed = mixed.join(_at_home(now, homes), "pair", "left_anti")
        mixed = staged(mixed, f"mixed-{turn}")
        if mixed.isEmpty():
            break
        opened = now.join(mixed, "pair")
        if not turn:
            chosen = opened.groupBy("pair").agg(F.array(*[
                F.min_by("key", F.xxhash64(F.lit(i), F.col("key"))) for i in range(CHOSEN)]).alias("some"))
            pairs = (opened.join(chosen, "pair").select("key", F.explode("some").alias("one"))
                     .filter("key <> one").select(F.least("key", "one").alias("a"),
                                                  F.greatest("key", "one").alias("b")).distinct())
            new = lists.links(staged(pairs, "pairs"))
        elif turn <= HOMES:
            home = staged(opened.groupBy("key").agg(F.max_by(
                "pair", F.struct("n", "pair")).alias(f"home{homes}")), f"home-{turn}")
            known = now.select("key", "component").distinct()
            new = lists.tile_links(home.join(known, "key").select(
                F.col(f"home{homes}").alias("pair"), "key", "component"))
            now, homes = now.join(home, "key", "left"), homes + 1
        else:
            new = lists.tile_links(opened.select("pair", "key", "component"))
        links = links.union(staged(new, f"links-{turn}"))
        found = staged(graph.components(links), f"components-{turn}")
        now = staged(now.drop("component").join(found.withColumnRenamed("node", "key"), "key", "left")
                     .withColumn("component", F.coalesce("component", "key")), f"lists-{turn}")
    return found


def near_duplicates(documents: DataFrame, size: int = 3, percent: int = 85,
                    coordinates: int = COORDINATES) -> DataFrame:
    """``key, doc_id, n_shingles, component_id, kept`` per document.

    Links are pairs of sets with ``100 * intersection >= percent * union``.
    """
    spark = documents.sparkSession
    bounded_batches(spark, 8)
    docs = keyed(documents, "doc_id", "text")
    sets = staged(docs.select("key", "doc_id", "text").mapInArrow(
        frugal(_signed(size, coordinates)), SETS), "sets")
    same = ["one", "two", "n_shingles"]
    classes = staged(sets.filter("n_shingles > 0").groupBy(*same).agg(
        F.min("key").alias("key"), F.min("doc_id").alias("least"),
        F.min_by("signature", "key").alias("signature")), "classes")
    found = _linked(_Lists(docs, classes, size, percent, coordinates))
    named = classes.select(*same, F.col("key").alias("node"), "least").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classed = named.join(least, "component").select(*same, "component", "component_id")
    joined = sets.join(classed, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("key", "doc_id", "n_shingles", component.alias("component_id"),
                         component.eqNullSafe(F.col("doc_id")).alias("kept"))
