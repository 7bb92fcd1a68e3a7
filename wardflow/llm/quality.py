"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad; its features are shape counts of the line itself and of the lines
before and after it, and neighbouring labels depend on each other. Forward-backward gives each
line's marginal, and a document's score is their mean, weighted by line length. The field is
fitted on the driver from a bounded sample of labelled documents, whose lines take the label of
their document.

Defined cases: NULL or empty text is one empty line, and empty lines weigh as one character; rows
with a NULL label or id are not learned from; without any label, or with labels of one kind only,
every score is 0.5 or near that kind; a document labelled twice counts for each label; rows that
repeat a document are scored each; an empty table gives no rows; columns other than those named
are not read, and labels, language, source and id never enter a score. A very long text is scored by
pieces of its lines, and a very long line by pieces of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wardflow.llm import words
from wardflow.llm.staging import bounded_batches, frugal, staged
from wardflow.llm.substrings import _binary

#: Bounds of the sample: labelled documents, and lines of each that are learned from.
SAMPLE, LINES = 2000, 32
#: Lines whose features are held at once.
LINES_AT_ONCE = 1 << 15
STEPS, RATE, SHRINK = 300, 0.2, 1e-4
#: Kinds of bytes counted per line.
_kind = np.full(256, 1, np.uint8)
_kind[[9, 10, 11, 12, 13, 32]] = 0
_kind[48:58] = 2
_kind[65:91] = 3
for _i, _text in enumerate((b".,;:?'\"-()", b"!", b"|", b"#$%&*", b"+/<=>@[\\]^_`{}~"), 4):
    _kind[list(_text)] = _i
KINDS, OWN = 9, 15


def line_features(lines: list[bytes], repeated: np.ndarray) -> np.ndarray:
    """One row of ``OWN`` numbers per line, none of them far above 1."""
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in lines])
    begins = ends - np.array([len(x) + 1 for x in lines])
    kind = _kind[data]
    counts = np.empty((len(lines), KINDS))
    for k in range(KINDS):
        sums = np.r_[0, np.cumsum(kind == k)]
        counts[:, k] = sums[ends] - sums[begins]
    starts, stops, hashes = words.word_hashes(data, True)
    line = np.searchsorted(ends, starts, side="right")
    n = np.bincount(line, minlength=len(lines)).astype(float)
    short = np.bincount(line, weights=(stops - starts <= 3), minlength=len(lines))
    order = np.lexsort((hashes, line))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (line[order[1:]] != line[order[:-1]])
    different = np.bincount(line[order][new], minlength=len(lines))
    size, letters = np.maximum(1, ends - begins - 1), np.maximum(1, counts[:, 1] + counts[:, 3])
    some, last = np.maximum(1, n), data[np.maximum(begins, ends - 2)]
    return np.column_stack([
        np.log1p(n) / 5, np.log1p(size) / 8, counts[:, 3] / letters, counts[:, 2] / size,
        *(np.minimum(1, 5 * counts[:, k] / size) for k in range(4, KINDS)),
        np.minimum(2, letters / some / 8), different / some, short / some,
        np.isin(last, list(b".!?")), (data[begins] >= 65) & (data[begins] < 91), repeated])


def _long_line(line: bytes, repeated: float) -> np.ndarray:
    """``line_features`` of one line, its bytes and words counted piece by piece."""
    counts, n, short, different = np.zeros(KINDS), 0, 0, np.zeros(0, np.uint64)
    for piece in words._pieces(line):
        for at in range(0, len(piece), words.PIECE):
            data = np.frombuffer(piece[at:at + words.PIECE], np.uint8)
            counts += np.bincount(_kind[data], minlength=KINDS)
        starts, stops, hashes = words.piece_hashes(piece, True)
        n, short = n + len(hashes), short + int((stops - starts <= 3).sum())
        different = np.union1d(different, hashes)
    size, letters, some = len(line), max(1, counts[1] + counts[3]), max(1, n)
    return np.array([[
        np.log1p(n) / 5, np.log1p(size) / 8, counts[3] / letters, counts[2] / size,
        *(min(1, 5 * counts[k] / size) for k in range(4, KINDS)),
        min(2, letters / some / 8), len(different) / some, short / some,
        line[-1] in b".!?", 65 <= line[0] < 91, repeated]], float)


def is_long(text: bytes) -> bool:
    """Is the text scored by pieces? That bounds memory and changes the score by rounding only."""
    return len(text) > words.PIECE or text.count(b"\n") >= LINES_AT_ONCE


def text_runs(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Index of the first and the texts of each run; a long text is a run of its own."""
    few, size, lines, first = [], 0, 0, 0
    for i, text in enumerate(texts):
        text = text or b""
        more = text.count(b"\n") + 1
        if few and (size + len(text) > words.PIECE or lines + more > LINES_AT_ONCE):
            yield first, few
            few, size, lines, first = [], 0, 0, i
        few.append(text)
        size, lines = size + len(text) + 1, lines + more
    if few:
        yield first, few


def line_runs(text: bytes) -> Iterator[list[bytes]]:
    """All lines of a text in order, few at a time; one longer than ``words.PIECE`` alone."""
    at = 0
    while True:
        cut = len(text)
        if cut - at > words.PIECE:
            cut = text.rfind(b"\n", at, at + words.PIECE)
            if cut < 0:
                cut = text.find(b"\n", at + words.PIECE)
            if cut < 0:
                cut = len(text)
        lines = text[at:cut].split(b"\n")
        for i in range(0, len(lines), LINES_AT_ONCE):
            yield lines[i:i + LINES_AT_ONCE]
        if cut == len(text):
            return
        at = cut + 1


def _own(lines: list[bytes], repeated: np.ndarray) -> np.ndarray:
    """Own features of the lines of a run, and a one."""
    own = (_long_line(lines[0], repeated[0]) if len(lines) == 1 and len(lines[0]) > words.PIECE
           else line_features(lines, repeated))
    return np.hstack([own, np.ones((len(lines), 1))])


def long_lines(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Weights and own features of the lines of a long text, in runs.

    A line that came before is told by 64 bits of its digest, which takes 8 bytes per different line.
    """
    seen = np.zeros(0, np.uint64)
    for lines in line_runs(text):
        digests = np.array([xxhash.xxh3_64_intdigest(x) for x in lines], np.uint64)
        different, at = np.unique(digests, return_index=True)
        new = np.zeros(len(lines), bool)
        place = np.searchsorted(seen, different)
        fresh = np.append(seen, np.uint64(0))[place] != different
        fresh |= place == len(seen)
        new[at[fresh]] = True
        seen = np.insert(seen, place[fresh], different[fresh])
        filled = np.array([bool(x) for x in lines])
        yield (np.maximum(1, np.array([len(x) for x in lines], float)),
               _own(lines, (filled & ~new).astype(float)))


def first_lines(text: bytes, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The runs of ``long_lines`` that hold the first ``n`` lines."""
    for run in long_lines(text):
        yield run
        n -= len(run[0])
        if n <= 0:
            return


def document_lines(few: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines per text, weights and features of all lines of a run of texts."""
    split = [text.split(b"\n") for text in few]
    lines = [line for text in split for line in text]
    repeated = []
    for text in split:
        seen: set[bytes] = set()
        for part in text:
            repeated.append(float(part in seen and bool(part)))
            seen.add(part)
    counts = np.array([len(x) for x in split])
    weights = np.maximum(1, np.array([len(x) for x in lines], float))
    return counts, weights, _beside(_own(lines, np.array(repeated)), counts)


def _beside(whole: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of each line, of the one before and of the one after it in the same text."""
    before, after = np.zeros_like(whole), np.zeros_like(whole)
    firsts = np.cumsum(counts) - counts
    has_before, has_after = np.ones(len(whole), bool), np.ones(len(whole), bool)
    has_before[firsts], has_after[firsts + counts - 1] = False, False
    at = np.flatnonzero(has_before)
    before[at] = whole[at - 1]
    at = np.flatnonzero(has_after)
    after[at] = whole[at + 1]
    return np.hstack([whole, before, after])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(emitted: np.ndarray, moves: np.ndarray, counts: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: label marginals, move marginals, log normaliser.

    ``emitted`` is (chains, lines, 2); lines at or after a chain's count are padding.
    """
    chains, length, _ = emitted.shape
    forward, backward = np.zeros_like(emitted), np.zeros_like(emitted)
    forward[:, 0] = emitted[:, 0]
    for t in range(1, length):
        step = _logsum(forward[:, t - 1, :, None] + moves, 1) + emitted[:, t]
        forward[:, t] = np.where((t < counts)[:, None], step, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = _logsum(moves + (emitted[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where((t + 1 < counts)[:, None], step, 0)
    total = _logsum(forward[:, -1], 1)
    label = np.exp(forward + backward - total[:, None, None])
    pair = np.exp(forward[:, :-1, :, None] + moves + (emitted[:, 1:] + backward[:, 1:])[:, :, None, :]
                  - total[:, None, None, None]) if length > 1 else np.zeros((chains, 0, 2, 2))
    pair *= (np.arange(1, length)[None] < counts[:, None])[:, :, None, None]
    return label, pair, total


class Field:
    """Weights per label and feature, and scores of moves between labels."""

    def __init__(self, features: int) -> None:
        self.weights, self.moves = np.zeros((features, 2)), np.zeros((2, 2))

    def fit(self, documents: list[np.ndarray], labels: np.ndarray) -> Field:
        """Gradient ascent (with adaptive steps) on the mean log-likelihood per document."""
        counts = np.array([len(d) for d in documents])
        x = np.zeros((len(documents), counts.max(), documents[0].shape[1]))
        for i, d in enumerate(documents):
            x[i, :len(d)] = d
        inside = (np.arange(x.shape[1])[None] < counts[:, None])[:, :, None]
        wanted = inside * np.eye(2)[labels][:, None, :]
        stays = np.zeros((2, 2))
        np.add.at(stays, (labels, labels), counts - 1)
        parts = [self.weights, self.moves]
        mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        for step in range(1, STEPS + 1):
            label, pair, _ = marginals(x @ self.weights, self.moves, counts)
            lines = counts.sum()
            slopes = [np.tensordot(x, wanted - label * inside, ([0, 1], [0, 1])) / lines,
                      (stays - pair.sum((0, 1))) / lines]
            for p, slope, m, s in zip(parts, slopes, mean, square):
                slope -= SHRINK * p
                m[:] = 0.9 * m + 0.1 * slope
                s[:] = 0.99 * s + 0.01 * slope ** 2
                p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
        return self

    def score(self, counts: np.ndarray, weights: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals of 'good', per document."""
        emitted, firsts = features @ self.weights, np.cumsum(counts) - counts
        scores, order, at = np.empty(len(counts)), np.argsort(counts, kind="stable"), 0
        while at < len(order):
            # Chains of like length together, so that padding stays below the lines themselves.
            to = at + 1
            while to < len(order) and counts[order[to]] <= 2 * counts[order[at]] and to - at < 4096:
                to += 1
            some = order[at:to]
            longest = counts[some].max()
            inside = np.arange(longest)[None] < counts[some][:, None]
            place = np.minimum(firsts[some][:, None] + np.arange(longest)[None], len(emitted) - 1)
            good = marginals(emitted[place], self.moves, counts[some])[0][:, :, 1]
            weight = weights[place] * inside
            scores[some] = (good * weight).sum(1) / weight.sum(1)
            at = to
        return np.clip(scores, 0.0, 1.0)


    def long_score(self, text: bytes) -> float:
        """``score`` of one long text: forward-backward over log odds, in some numbers per line.

        A line's emission is the sum of what it, the line before and the line after contribute.
        """
        own, before, after = (self.weights[:, 1] - self.weights[:, 0]).reshape(3, OWN + 1)
        odds, weights, last = [], [], 0.0
        for weight, whole in long_lines(text):
            emitted, to_next, to_last = whole @ own, whole @ before, whole @ after
            emitted[1:] += to_next[:-1]
            emitted[0] += last
            emitted[:-1] += to_last[1:]
            if odds:
                odds[-1][-1] += to_last[0]
            last = to_next[-1]
            odds.append(emitted)
            weights.append(weight.astype(np.int32))
        emitted, weights = np.concatenate(odds), np.concatenate(weights).astype(float)
        del odds
        stay0, to1, to0, stay1 = self.moves.ravel().tolist()
        forward = np.empty(len(emitted))
        at = 0.0
        for part in range(0, len(emitted), LINES_AT_ONCE):
            found = emitted[part:part + LINES_AT_ONCE].tolist()
            for t, e in enumerate(found):
                at = e + (_logadd(to1, at + stay1) - _logadd(stay0, at + to0) if part or t else 0.0)
                found[t] = at
            forward[part:part + len(found)] = found
        at = 0.0
        for part in range((len(emitted) - 1) // LINES_AT_ONCE * LINES_AT_ONCE, -1, -LINES_AT_ONCE):
            found = emitted[part:part + LINES_AT_ONCE].tolist()
            for t in range(len(found) - 1, -1, -1):
                e, found[t] = found[t], at
                at = _logadd(to0, stay1 + e + at) - _logadd(stay0, to1 + e + at)
            forward[part:part + len(found)] += found
        good = 1 / (1 + np.exp(-np.clip(forward, -700, 700)))
        return float(np.clip((good * weights).sum() / weights.sum(), 0.0, 1.0))


def _logadd(x: float, y: float) -> float:
    return max(x, y) + log1p(exp(-abs(x - y)))


def _sampled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], batch.column("quality").to_pylist()
        for first, few in text_runs(_binary(batch.column("text"))):
            if is_long(few[0]):
                # The line after the last one learned from counts among its neighbours.
                some = np.vstack([whole for _, whole in first_lines(few[0], LINES + 1)])[:LINES + 1]
                counts, features = np.array([len(some)]), _beside(some, np.array([len(some)]))
            else:
                counts, _, features = document_lines(few)
            at = 0
            for i, count in enumerate(counts.tolist()):
                part = features[at:at + min(count, LINES)].astype(np.float32)
                rows.append((labels[first + i], part.tobytes()))
                at += count
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["quality", "features"])


def fitted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """The field from ``doc_id, text`` and ``doc_id, quality``, by the ``sample`` least id hashes.

    Only ids meet the labels; the chosen ones, at most ``sample``, then find their texts.
    """
    bounded_batches(documents.sparkSession)
    usable = (documents.select("doc_id").filter("doc_id IS NOT NULL")
              .join(labels.filter("quality IN (0, 1)"), "doc_id").select("doc_id", "quality").distinct())
    ids = staged(usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample), "sample")
    chosen = documents.join(F.broadcast(ids), "doc_id")
    rows = (chosen.select(F.col("quality").cast("int").alias("quality"), "text")
            .mapInArrow(_sampled_features, "quality int, features binary")
            .orderBy("quality", "features").limit(2 * sample).collect())
    width = 3 * (OWN + 1)
    field = Field(width)
    if not rows:
        return field
    documents = [np.frombuffer(r.features, np.float32).reshape(-1, width).astype(float) for r in rows]
    return field.fit(documents, np.array([r.quality for r in rows]))


def scored(documents: DataFrame, field: Field) -> DataFrame:
    """``documents`` with ``score`` (in place of one of that name): the text is good, 0 to 1."""
    documents = documents.drop("score")
    bounded_batches(documents.sparkSession)
    schema = StructType([*documents.schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, few in text_runs(_binary(batch.column("text"))):
                found.append(np.array([field.long_score(few[0])]) if is_long(few[0])
                             else field.score(*document_lines(few)))
            found = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             names=[*batch.schema.names, "score"])

    return documents.mapInArrow(frugal(run), schema)


def quality_scores(documents: DataFrame, labels: DataFrame, held_out, cut: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted``; labels of held-out documents are not learned from."""
    marked = documents.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    field = fitted(marked.filter("NOT held_out"), labels.select("doc_id", "quality"))
    return (scored(marked, field).drop("text")
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))
