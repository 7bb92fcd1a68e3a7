"""Which of very many hashes occur more than once, and where.

Hashes travel in packed arrays, dealt to tasks by their value. A task that makes them first looks
for repeats of its own: places whose hash it has met twice are settled there, and of such a hash
only a witness is sent. So a hash that a third of all rows share reaches its task about once per
batch, never once per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wardflow.llm import words

PACKED = "bucket int, kind int, hashes binary, more binary, keys binary, places binary"
RETURNED = "bucket int, keys binary, places binary"
FOUND = "key long, places array<int>"
ASK, WITNESS, SETTLED = 0, 1, 2
#: Hashes gathered before they are packed: about 50 MB with what sorting them takes.
GATHERED = 1_000_000
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("hashes", pa.binary()),
                     ("more", pa.binary()), ("keys", pa.binary()), ("places", pa.binary())])


def buckets(spark: SparkSession) -> int:
    """Twice the shuffle partitions: even enough, and few packed rows from a small task."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _repeated(hashes: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash, and for each place in that order whether the hash is there twice."""
    order = np.lexsort((more, hashes))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ((hashes[order[1:]] == hashes[order[:-1]])
                  & (more[order[1:]] == more[order[:-1]]))
    return order, same


def _packed(kind: int, n: int, hashes, more, keys, places) -> Iterator[tuple]:
    if not len(hashes):
        return
    bucket = ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        yield (int(bucket[part[0]]), kind, hashes[part].tobytes() if kind != SETTLED else b"",
               more[part].tobytes() if kind != SETTLED else b"",
               keys[part].tobytes() if kind != WITNESS else b"",
               places[part].tobytes() if kind != WITNESS else b"")


def pack(gathered: list[tuple], n: int) -> pa.RecordBatch:
    """One batch of packed rows from ``(hashes, more, keys, places)`` arrays."""
    hashes, more, keys, places = (np.concatenate(x) for x in zip(*gathered))
    order, same = _repeated(hashes, more)
    twice = same[1:] | same[:-1]
    first = twice & ~same[:-1]
    rows = []
    for kind, chosen in ((ASK, ~twice), (WITNESS, first), (SETTLED, twice)):
        at = np.sort(order[chosen])
        rows += _packed(kind, n, hashes[at], more[at], keys[at], places[at])
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def packing(made: Iterator[tuple], n: int) -> Iterator[pa.RecordBatch]:
    """Pack a stream of ``(hashes, more, keys, places)``."""
    gathered, size = [], 0
    for some in made:
        gathered.append(some)
        size += len(some[0])
        if size >= GATHERED:
            yield pack(gathered, n)
            gathered, size = [], 0
    if size:
        yield pack(gathered, n)


def _lists(keys: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    starts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1] if len(keys) else np.zeros(0, int)
    offsets = np.r_[starts, len(keys)].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[starts], pa.int64()),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(places, pa.int32()))],
        names=["key", "places"])


def _returned(keys: np.ndarray, places: np.ndarray, n: int) -> pa.RecordBatch:
    """Places packed by the bucket of their key, so that each key's come together again."""
    bucket = (words.mixed(keys.astype(np.uint64)) % np.uint64(n)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(keys) else []
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[p[0]]) for p in parts], pa.int32()),
         pa.array([keys[p].tobytes() for p in parts], pa.binary()),
         pa.array([places[p].tobytes() for p in parts], pa.binary())],
        names=["bucket", "keys", "places"])


def _settle(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, witnesses, settled, held = [], [], [], 0
        for batch in batches:
            for _, kind, hashes, more, keys, places in zip(*(c.to_pylist() for c in batch.columns)):
                hashes, more = np.frombuffer(hashes, np.uint64), np.frombuffer(more, np.uint32)
                keys, places = np.frombuffer(keys, np.int64), np.frombuffer(places, np.int32)
                if kind == ASK:
                    asked.append((hashes, more, keys, places))
                elif kind == WITNESS:
                    witnesses.append((hashes, more))
                else:
                    settled.append((keys, places))
                    held += len(keys)
            if held > GATHERED:
                yield _returned(*(np.concatenate(x) for x in zip(*settled)), n)
                settled, held = [], 0
        if asked:
            hashes, more, keys, places = (np.concatenate(x) for x in zip(*asked))
            known = [np.concatenate(x) for x in zip(*witnesses)] if witnesses else [hashes[:0], more[:0]]
            # A witness stands for two places at least.
            order, same = _repeated(np.concatenate([hashes, known[0], known[0]]),
                                    np.concatenate([more, known[1], known[1]]))
            found = order[same[1:] | same[:-1]]
            found = found[found < len(hashes)]
            settled.append((keys[found], places[found]))
        if settled:
            yield _returned(*(np.concatenate(x) for x in zip(*settled)), n)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key: all places of a key are in this task."""
    held = [(np.frombuffer(keys, np.int64), np.frombuffer(places, np.int32))
            for batch in batches for keys, places in zip(*(batch.column(c).to_pylist()
                                                           for c in ("keys", "places")))]
    if held:
        yield _lists(*(np.concatenate(x) for x in zip(*held)))


def repeated_places(packed: DataFrame, n: int) -> DataFrame:
    """``key, places``: all places of a row whose hash occurs elsewhere too, one row per key."""
    tasks = max(1, n // 2)
    back = packed.repartition(tasks, "bucket").mapInArrow(_settle(n), RETURNED)
    return back.repartition(tasks, "bucket").mapInArrow(_gathered, FOUND)
