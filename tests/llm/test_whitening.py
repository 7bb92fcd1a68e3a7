"""Whitening against dense eigenvectors, and its parts against what they update."""

import math

import numpy as np
import pytest

from wardflow.llm import whitening
from wardflow.llm.whitening import Spectrum, secular

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("k", [1, 2, 7, 40])
def test_secular_roots_and_vectors(k):
    rng = np.random.default_rng(k)
    for rho in (1e-8, 1.0, 1e6):
        d = np.sort(rng.normal(size=k) ** 2 * 10 ** rng.uniform(-5, 3, k))
        z = rng.normal(size=k)
        values, vectors = secular(d, z, rho)
        dense = np.diag(d) + rho * np.outer(z, z)
        size = np.abs(dense).max()
        assert np.abs(values - np.linalg.eigvalsh(dense)).max() < 1e-13 * size * k
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
        assert np.abs(vectors * values @ vectors.T - dense).max() < 1e-12 * size * k


def vectors(n, width=12, seed=0):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width)) * np.linspace(0.1, 1, width)
    rows[:, 3] = rows[:, 2]
    return rows


def scatter(x):
    return (x - x.mean(0)).T @ (x - x.mean(0))


def close(spectrum, x):
    dense = scatter(x)
    assert spectrum.n == len(x) and np.allclose(spectrum.mean, x.mean(0), atol=1e-12)
    back = spectrum.basis * spectrum.weights @ spectrum.basis.T
    assert np.abs(back - dense).max() < 1e-10 * max(1, np.abs(dense).max())
    width = x.shape[1]
    assert np.abs(spectrum.basis.T @ spectrum.basis - np.eye(width)).max() < 1e-10


def test_rank_one_updates_with_repeats_and_constant_entries():
    x = np.floor(64 * vectors(300))
    x[:, 5] = 7
    x[100:200] = x[0]
    spectrum = Spectrum(x.shape[1])
    for i, row in enumerate(x):
        spectrum.add(row)
        if i in (0, 1, 4, 50, 250):
            close(spectrum, x[:i + 1])
    close(spectrum, x)


def test_spectra_join():
    x = np.floor(64 * vectors(120))
    parts = [Spectrum(12) for _ in range(4)]
    for part, rows in zip(parts, (x[:1], x[1:8], x[8:60], x[60:])):
        for row in rows:
            part.add(row)
    whole = Spectrum(12)
    for part in parts:
        whole.join(part)
    whole.join(Spectrum(12))
    close(whole, x)


def brute(rows, most):
    """Rows by vec_id and component, from exact sums and a dense eigendecomposition."""
    good = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in good}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    away = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, basis = np.linalg.eigh(away.T @ away / n)
    values, basis = values[::-1], basis[:, ::-1]
    return {(i, k + 1): (n, sum((n * c - s) ** 2 for c, s in zip(v, sums)),
                         float((np.array([(n * c - s) / n for c, s in zip(v, sums)]) @ basis[:, k])
                               / math.sqrt(values[k])), values[k] / values.sum())
            for i, v in x.items() for k in range(min(most, len(values))) if values[k] > 1e-10 * values[0]}


def held(spark, rows, most=16):
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(5), most).collect()
    want = brute(rows, most)
    assert sorted((r.vec_id, r.component) for r in got) == sorted(want)
    signs = {}
    for r in got:
        n, deviation, value, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - abs(value)) < 1e-7
        if abs(value) > 1e-3:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened * value))
        assert r.explained == pytest.approx(explained, rel=1e-6) and r.identity_error < 1e-6
    assert all(len(s) == 1 for s in signs.values())
    return got


def test_whitening_equals_dense_eigenvectors(spark):
    data = vectors(900, 20)
    rows = [(i, [float(c) for c in data[i % 700]], 1) for i in range(900)]
    held(spark, rows)


def test_many_partitions_combine(spark, monkeypatch):
    monkeypatch.setattr(whitening, "WORTH", 5)
    monkeypatch.setattr(whitening, "JOINED", 3)
    data = vectors(300, 8, 7)
    held(spark, [(i, [float(c) for c in data[i]], 1) for i in range(300)], 5)


def test_a_third_of_equal_vectors_and_bad_ones(spark):
    data = vectors(200, 6, 3)
    rows = [(i, [float(c) for c in (data[0] if i % 3 else data[i])], None) for i in range(200)]
    bad = [(900, None, 1), (901, [], 1), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1),
           (903, [float("nan")] * 6, 1), (904, [float("inf")] + [0.0] * 5, 1)]
    assert {r.vec_id for r in held(spark, rows + bad)} == set(range(200))
    other = [(905, [1.0, 2.0], 1), (906, [1e30] * 6, 1)]
    got = whitening.whitened(spark.createDataFrame(rows + other, SCHEMA)).collect()
    assert {r.vec_id for r in got} == set(range(200))


def test_fewer_components_where_variance_is_zero(spark):
    held(spark, [(1, [0.0, 1.0, 2.0], 1), (2, [4.0, 1.0, 2.0], 1), (2, [5.0, 1.0, 3.0], 1)][:2])
    rows = [(i, [1.0, 2.0], 1) for i in range(5)]
    assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).count() == 0
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_columns_and_repeated_ids(spark):
    rows = [(1, [float(i), 1.0 / (i + 1)], 1, 5, 0.5) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA + ", n long, whitened double")
    got = whitening.whitened(df).collect()
    assert len(got) == 12 and {r.n for r in got} == {6}


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(1 << 38) * i, 0.5 * i], 1) for i in range(4)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA), 1).collect()
    assert len(got) == 4 and {r.deviation for r in got} == {None}
