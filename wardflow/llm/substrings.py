"""Substring dedup by difference-cover anchors.

A set of residues modulo ``PERIOD`` such that every difference modulo it is one of two of them
makes any two positions meet: of two equal runs of ``LENGTH`` words, wherever they start, some
anchor windows of ``LENGTH - PERIOD + 1`` words lie at the same place within both. So only windows
at cover positions, about a third, are hashed and dealt out. Around anchors that occur twice the
match is extended to whole windows of ``LENGTH`` words, which are then compared by 96 bits. No
pair of places is ever made.

Defined cases: NULL or empty text has no words and the digest of the empty text; a text of fewer
than ``LENGTH`` words keeps all; rows that repeat a document repeat its windows, so these go from
each of them; an empty table gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import repeats, words
from wardflow.llm.staging import bounded_batches, keyed

LENGTH, PERIOD, COVER = 35, 13, (0, 1, 3, 9)


def _binary(column: pa.Array) -> list[bytes | None]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def _places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the index of its text and its place there."""
    text = np.repeat(np.arange(len(counts)), counts)
    return text, np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)


def _anchors(length: int, period: int, cover: tuple[int, ...], n: int):
    size, chosen = length - period + 1, np.isin(np.arange(period), cover)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, counts, hashes in words.hashed(_binary(batch.column("text"))):
                text, place = _places(counts)
                found = words.windows(hashes, size)
                text, place = text[:len(found)], place[:len(found)]
                count = counts[text]
                at = np.flatnonzero(chosen[place % period] & (place + size <= count)
                                    & (count >= length))
                yield (found[at], np.zeros(len(at), np.uint32), keys[first + text[at]],
                       place[at].astype(np.int32))

    return lambda batches: repeats.packing(made(batches), n)


def _extended(length: int, period: int, n: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            anchors = batch.column("places")
            for first, counts, hashes in words.hashed(_binary(batch.column("text"))):
                if len(hashes) < length:
                    continue
                text, place = _places(counts)
                begins = np.cumsum(counts) - counts
                here = anchors.slice(first, len(counts))
                offsets = here.offsets.to_numpy()
                at = (here.values.to_numpy()[offsets[0]:offsets[-1]]
                      + np.repeat(begins, np.diff(offsets)))
                # Windows that start up to a period before an anchor, within the same text.
                marks = np.zeros(len(hashes) + 1, np.int32)
                np.add.at(marks, np.maximum(at - period + 1, np.repeat(begins, np.diff(offsets))), 1)
                np.add.at(marks, at + 1, -1)
                near = np.cumsum(marks[:-1]) > 0
                chosen = np.flatnonzero(near & (place + length <= counts[text]))
                one = words.windows(hashes, length)[chosen]
                two = (words.windows(hashes, length, 1)[chosen] >> np.uint64(32)).astype(np.uint32)
                yield one, two, keys[first + text[chosen]], place[chosen].astype(np.int32)

    return lambda batches: repeats.packing(made(batches), n)


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts in zip(_binary(batch.column("text")),
                                    batch.column("places").to_pylist()):
                parts = (text or b"").split()
                gone = np.zeros(len(parts) + 1, np.int32)
                if starts:
                    np.add.at(gone, np.array(starts), 1)
                    np.add.at(gone, np.array(starts) + length, -1)
                kept = np.cumsum(gone[:-1]) == 0
                left = parts if kept.all() else [parts[i] for i in np.flatnonzero(kept)]
                left = b" ".join(left)
                rows.append((len(parts), int((~kept).sum()), left.decode(),
                             hashlib.sha256(left).hexdigest()))
            n, gone, left, digest = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(left, pa.string()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return run


def without_repeats(documents: DataFrame, length: int = LENGTH, period: int = PERIOD,
                    cover: tuple[int, ...] = COVER) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256``: texts without their repeated windows."""
    differences = {(a - b) % period for a in cover for b in cover}
    if len(differences) < period or period > length:
        raise ValueError(f"{cover} does not cover all differences modulo {period} below {length}")
    spark = documents.sparkSession
    bounded_batches(spark)
    n = repeats.buckets(spark)
    docs = keyed(documents, "doc_id", "text")
    # Both joins read the same columns and filter, so Spark deals the texts out once.
    texts = docs.select("key", "doc_id", "text").filter("key IS NOT NULL")
    anchors = repeats.repeated_places(
        texts.select("key", "text").mapInArrow(_anchors(length, period, cover, n),
                                               repeats.PACKED), n)
    near = texts.join(anchors, "key").select("key", "doc_id", "text", "places")
    found = repeats.repeated_places(near.mapInArrow(_extended(length, period, n),
                                                    repeats.PACKED), n)
    return (texts.join(found, "key", "left").select("doc_id", "text", "places")
            .mapInArrow(_removed(length), "doc_id long, n_words long, n_removed long, kept string, "
                                          "kept_sha256 string"))
