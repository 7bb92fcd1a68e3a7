"""Embedding whitening by incremental eigendecomposition.

Every partition keeps the spectrum of its vectors' scatter: count, mean, orthonormal directions and
their weights. A vector changes it by a centred rank-one update, whose new weights are the roots of
a secular equation; directions that the vector doesn't touch, and those of equal weight, are
deflated beforehand. Partitions' spectra are combined by the same updates, one per direction of the
other spectrum and one for the distance of the means, a few spectra per task until one is left.
Its directions, which carry the rounding of all updates, are the basis of a Rayleigh-Ritz step over
all vectors: their covariance in that basis is summed up distributed, nearly diagonal, and its
eigenvectors turn the basis into components exact to rounding.

Vectors are quantised to whole numbers, so counts and sums are exact, and are centred as
``n * x - S`` in whole numbers before any product; where the sum of their squares leaves 64 bits,
which takes millions of vectors, it is NULL. Copies count once: the fit list holds each
quantised vector once.

Defined cases: vectors that are NULL, empty, hold NULL, non-finite or huge entries, or differ in
length from the most frequent one (the longest of equally frequent ones) are dropped; repeated ids are
each a row; components whose variance is zero up to rounding can't be scaled to one and are left
out, so there may be fewer than asked for, and none where all vectors are equal; an empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.staging import staged

SCALE = 64
#: Vectors with larger entries are dropped; their sums would leave 64 bits.
LARGEST = 1 << 40
#: Spectra combined by one task.
JOINED = 16
#: So many vectors are worth a task of their own.
WORTH = 1024
#: Variances below this part of the largest one are rounding.
NEGLIGIBLE = 1e-10
_EPS = np.finfo(float).eps


class Spectrum:
    """Scatter ``basis @ diag(weights) @ basis.T`` of ``n`` vectors around their ``mean``.

    ``weights`` ascend.
    """

    def __init__(self, width: int, n: int = 0, mean=None, weights=None, basis=None) -> None:
        self.n = n
        self.mean = np.zeros(width) if mean is None else mean
        self.weights = np.zeros(width) if weights is None else weights
        self.basis = np.eye(width) if basis is None else basis

    def add(self, x: np.ndarray) -> None:
        """One more vector: a rank-one update by its distance from the mean."""
        away = x - self.mean
        self._update(away, self.n / (self.n + 1.0))
        self.n += 1
        self.mean = self.mean + away / self.n

    def join(self, other: Spectrum) -> None:
        """The vectors of another spectrum: an update per direction, and one for the means."""
        if not other.n:
            return
        for weight, direction in zip(other.weights, other.basis.T):
            if weight > 0:
                self._update(direction, weight)
        total, away = self.n + other.n, other.mean - self.mean
        self._update(away, self.n * (other.n / total))
        self.mean, self.n = self.mean + away * (other.n / total), total

    def _update(self, vector: np.ndarray, rho: float) -> None:
        """Add ``rho * vector @ vector.T`` to the scatter."""
        z = self.basis.T @ vector
        length = float(np.sqrt(z @ z))
        if not rho * length * length > 0:
            return
        z, rho = z / length, rho * length * length
        near = 8 * _EPS * max(self.weights[-1], rho)
        self._merge_equal(z, near)
        moved = np.flatnonzero(np.abs(z) * rho > near)
        if len(moved) == 0:
            return
        weights, turn = secular(self.weights[moved], z[moved], rho)
        self.weights[moved] = weights
        self.basis[:, moved] = self.basis[:, moved] @ turn
        order = np.argsort(self.weights, kind="stable")
        if np.any(order[1:] < order[:-1]):
            self.weights, self.basis = self.weights[order], self.basis[:, order]

    def _merge_equal(self, z: np.ndarray, near: float) -> None:
        """Reflect directions of equal weight, so that only the last one of them touches ``z``."""
        ends = np.flatnonzero(np.diff(self.weights) > near) + 1
        starts, ends = np.r_[0, ends], np.r_[ends, len(z)]
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            part = z[a:b]
            length = np.sqrt(part @ part)
            mirror = part.copy()
            mirror[-1] += length if part[-1] >= 0 else -length
            size = mirror @ mirror
            if size > 0:
                block = self.basis[:, a:b]
                self.basis[:, a:b] = block - np.outer(block @ mirror, mirror * (2 / size))
                sign = -1.0 if part[-1] >= 0 else 1.0
                z[a:b] = 0.0
                z[b - 1] = sign * length


def secular(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of ``diag(d) + rho * z @ z.T``; ``d`` ascends strictly.

    Root i of ``1 + rho * sum(z^2 / (d - x))`` lies between ``d[i]`` and ``d[i + 1]``, the last one
    at most ``rho * z @ z`` above ``d[-1]``. Each is sought as its distance from the nearer pole, by
    steps that fit a pole on either side, kept within a shrinking bracket. Vectors come from the
    ``z`` for which the found roots are exact, so that they are orthogonal to rounding.
    """
    k = len(d)
    square = z * z
    upper = np.r_[d[1:], d[-1] + rho * square.sum()]
    gap = upper - d
    middle = d + gap / 2
    at_middle = 1 + rho * (square / (d - middle[:, None])).sum(1)
    left = (at_middle >= 0) | (np.arange(k) == k - 1)
    origin = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d - d[origin][:, None]
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, np.where(np.arange(k) == k - 1, gap, gap / 2), 0.0)
    x = (low + high) / 2
    own = np.arange(k)
    after, last = np.minimum(own + 1, k - 1), own == k - 1
    open_ = own
    for _ in range(80):
        gaps, y, at_end = delta[open_], x[open_], last[open_]
        rows = np.arange(len(open_))
        with np.errstate(divide="ignore", invalid="ignore"):
            away = gaps - y[:, None]
            terms = rho * square / away
            value = 1 + terms.sum(1)
            noise = 8 * _EPS * (1 + np.abs(terms).sum(1))
            going = np.abs(value) > noise
            lo, hi = np.where(value < 0, y, low[open_]), np.where(value >= 0, y, high[open_])
            going &= hi - lo > 2 * _EPS * np.abs(y)
            if not going.any():
                break
            # Fit c + s / (own pole - t) + u / (next pole - t) to the value and slopes at y.
            slopes = terms / away
            running = np.cumsum(slopes, axis=1)
            psi = running[rows, open_]
            phi = running[:, -1] - psi
            p = away[rows, open_]
            q = np.where(at_end, 0.0, away[rows, after[open_]])
            c = value - p * psi - q * phi
            s, u = psi * p * p, phi * q * q
            # With t = y + step: c (p - step)(q - step) + s (q - step) + u (p - step) = 0.
            a1, a0 = -(c * (p + q) + s + u), c * p * q + s * q + u * p
            root = np.sqrt(np.maximum(a1 * a1 - 4 * c * a0, 0))
            step = np.where(at_end, p + s / c, np.where(
                a1 <= 0, 2 * a0 / (-a1 + root), (-a1 - root) / (2 * c)))
            new = y + step
        inside = np.isfinite(new) & (new > lo) & (new < hi)
        low[open_], high[open_] = lo, hi
        x[open_] = np.where(going, np.where(inside, new, (lo + hi) / 2), y)
        open_ = open_[going]
    apart = delta - x[:, None]
    apart = np.where(apart == 0, np.finfo(float).tiny, apart)
    # d[j] - root i as apart[i, j]; Loewner's formula for the z that belongs to these roots.
    others = d - d[:, None]
    np.fill_diagonal(others, 1.0)
    exact = np.sqrt(np.abs(np.prod(apart / others, axis=0)))
    vectors = (np.copysign(exact, z) / apart).T
    return d[origin] + x, vectors / np.sqrt((vectors * vectors).sum(0))


def _packed(spectrum: Spectrum) -> dict:
    return {"n": spectrum.n, "mean": spectrum.mean.tolist(), "weights": spectrum.weights.tolist(),
            "basis": spectrum.basis.ravel().tolist()}


def _unpacked(row: dict) -> Spectrum:
    weights = np.array(row["weights"])
    return Spectrum(len(weights), row["n"], np.array(row["mean"]), weights,
                    np.array(row["basis"]).reshape(len(weights), -1))


SPECTRUM = "place long, n long, mean array<double>, weights array<double>, basis array<double>"
_ARROW = pa.schema([("place", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())),
                    ("weights", pa.list_(pa.float64())), ("basis", pa.list_(pa.float64()))])


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(column))
    return np.asarray(values.flatten()).reshape(-1, width)


def spectra(fit: DataFrame, width: int, parts: int) -> DataFrame:
    """One spectrum per partition of the fit list (column ``x``), by rank-one updates."""
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum(width)
        for batch in batches:
            for x in _matrix(batch, "x", width).astype(float):
                spectrum.add(x)
        if spectrum.n:
            yield pa.RecordBatch.from_pylist([{"place": 0} | _packed(spectrum)], _ARROW)

    dealt = fit.select("x").repartition(parts, "x").mapInArrow(of_partition, SPECTRUM)
    return staged(dealt.withColumn("place", F.spark_partition_id().cast("long")), "spectra")


def combined(found: DataFrame, parts: int) -> Spectrum:
    """All spectra joined, ``JOINED`` per task and round, until one row is left."""
    def joined(key, rows):
        few = sorted(rows.to_pylist(), key=lambda row: row["place"])
        whole = _unpacked(few[0])
        for row in few[1:]:
            whole.join(_unpacked(row))
        return pa.Table.from_pylist([{"place": key[0].as_py()} | _packed(whole)], _ARROW)

    while parts > 1:
        to = F.floor(F.col("place") / JOINED).alias("to")
        found = staged(found.groupBy(to).applyInArrow(joined, SPECTRUM), "spectra")
        parts = -(-parts // JOINED)
    return _unpacked(found.first().asDict())


def quantised(vector: Column) -> Column:
    """``floor(SCALE * c)`` of each entry as a whole number.

    An offset that made all entries positive would change neither distances from the mean nor
    directions, so none is added.
    """
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite and of a size that can be quantised."""
    fine = F.forall(vector, lambda c: F.coalesce(
        F.abs(c.cast("double")) < F.lit(float(LARGEST)), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def _sums(fit: DataFrame, width: int) -> tuple[int, np.ndarray, int]:
    """Number of vectors, exact sums per entry, and the widest range of an entry."""
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "x", width)
            if len(x):
                yield pa.RecordBatch.from_pydict({
                    "i": np.arange(width), "n": np.full(width, len(x)), "s": x.sum(0),
                    "low": x.min(0), "high": x.max(0)})

    parts = fit.select("x").mapInArrow(of_partition, "i long, n long, s long, low long, high long")
    rows = (parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"),
                                   (F.max("high") - F.min("low")).alias("range"))
            .orderBy("i").collect())
    return rows[0]["n"], np.array([r["s"] for r in rows]), max(r["range"] for r in rows)


def _second_moments(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the fit list in the given basis, summed up per partition."""
    width, k = basis.shape

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((k, k))
        for batch in batches:
            seen = ((n * _matrix(batch, "x", width) - sums) / n) @ basis
            gram += seen.T @ seen
        yield pa.RecordBatch.from_pydict({"i": np.arange(k * k), "v": gram.ravel()})

    parts = fit.select("x").mapInArrow(of_partition, "i long, v double")
    rows = parts.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    return np.array([r["v"] for r in rows]).reshape(k, k) / n


def components(fit: DataFrame, most: int = 16) -> dict | None:
    """``n, sums, spread, trace``, eigenvalues ``values`` (falling) and ``vectors`` in columns, at most
    ``most``; and ``error``, the largest entry of the whitened covariance minus the identity.

    ``fit`` has distinct vectors ``x``. Signs are chosen so that the entry of largest size of each
    component is positive. The driver holds matrices of the vectors' width only.
    """
    first = fit.first()
    if first is None:
        return None
    width = len(first["x"])
    n, sums, spread = _sums(fit, width)
    spark = fit.sparkSession
    workers = max(spark.sparkContext.defaultParallelism,
                  int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = min(-(-n // WORTH), workers)
    spectrum = combined(spectra(fit, width, parts), parts)
    basis = np.linalg.qr(spectrum.basis[:, ::-1])[0]
    values, turn = np.linalg.eigh(_second_moments(fit, n, sums, basis))
    trace, values, vectors = float(values.sum()), values[::-1], (basis @ turn)[:, ::-1]
    kept = min(most, int((values > NEGLIGIBLE * values[0]).sum()) if values[0] > 0 else 0)
    values, vectors = values[:kept], vectors[:, :kept]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(kept)]
    vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    error = 0.0
    if kept:
        seen = _second_moments(fit, n, sums, vectors / np.sqrt(values))
        error = float(np.abs(seen - np.eye(kept)).max())
    return {"n": n, "sums": sums, "spread": spread, "trace": trace, "values": values,
            "vectors": vectors, "error": error}


def _length(vectors: DataFrame) -> int | None:
    """The most frequent length, the longest of equally frequent ones."""
    row = (vectors.groupBy(F.size("x").alias("width")).count()
           .agg(F.max(F.struct("count", "width")).alias("top")).first()["top"])
    return row["width"] if row else None


def whitened(embeddings: DataFrame, most: int = 16) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``."""
    out = ("vec_id long, component int, n long, deviation long, whitened double, "
           "explained double, identity_error double")
    seen = staged(embeddings.filter(usable(F.col("embedding"))).select(
        "vec_id", quantised(F.col("embedding")).alias("x")), "vectors")
    width = _length(seen)
    rows = seen.filter(F.size("x") == F.lit(width))
    fit = staged(rows.select("x").distinct(), "fit")
    model = components(fit, most)
    if model is None or not len(model["values"]):
        return seen.sparkSession.createDataFrame([], out)
    n, total, kept, error = model["n"], model["sums"], len(model["values"]), model["error"]
    turn = model["vectors"] / np.sqrt(model["values"])
    explained = model["values"] / model["trace"]
    fits = width * (n * model["spread"]) ** 2 < 1 << 63

    def squared(away: np.ndarray) -> pa.Array:
        if fits:
            return pa.array((away * away).sum(1))
        exact = (away.astype(object) ** 2).sum(1)
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = n * _matrix(batch, "x", width) - total
            count = len(away)
            each = pa.array(np.repeat(np.arange(count), kept))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).take(each),
                "component": np.tile(np.arange(1, kept + 1, dtype=np.int32), count),
                "n": np.full(count * kept, n), "deviation": squared(away).take(each),
                "whitened": ((away / n) @ turn).ravel(), "explained": np.tile(explained, count),
                "identity_error": np.full(count * kept, error)})

    return rows.select("vec_id", "x").mapInArrow(project, out)
