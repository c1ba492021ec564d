"""Whitening against whole-number sums and numpy's eigenvectors, with nulls, ragged vectors, ties, clusters and clashing columns."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ratewright.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string"


def whole(vectors):
    d = max(map(len, vectors))
    return [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] + [100_000] * (d - len(v)) for v in vectors]


def is_usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def sample(seed=3, n=300, d=12):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1 / (1 + k)) for k in range(d)] for _ in range(n)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(n, None), (n + 1, [None] * d), (n + 2, [float("nan"), *base[0][1:]]), (n + 3, [float("inf"), *base[0][1:]]), (n + 4, base[0][: d // 2]), (n + 5, []), rows[5], rows[5], (None, base[1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "m") for i, v in rows], SCHEMA).repartition(5)


def test_whitening_equals_numpy(spark):
    rows = sample()
    kept = [(i, v) for i, v in rows if is_usable(v)]
    x = whole([v for _, v in kept])
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array(x, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    found = whitening.whiten(frame(spark, rows), "vec_id", "embedding").collect()
    assert len(found) == 8 * n
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    deviation = {}
    for (i, _), row in zip(kept, x, strict=True):
        deviation.setdefault(i, set()).add(sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)))
    for c in range(1, 9):
        e, u = values[-c], vectors[:, -c]
        want = centred @ u / math.sqrt(e)
        sign = np.sign(want[0] * by[0, c][0]["whitened"])
        for (i, _), w in zip(kept, want, strict=True):
            for r in by[i, c]:
                assert abs(r["whitened"] - sign * w) < 1e-9 and r["n"] == n and r["deviation"] in deviation[i]
                assert abs(r["explained"] - e / values.sum()) < 1e-12 and r["identity_error"] < 1e-9


@pytest.mark.parametrize("spread", [1.0, 1e-7, 1e-12, 0.0])
def test_clustered_eigenvalues(spread):
    rng = np.random.default_rng(7)
    d = 24
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    q = whitening._orthonormal(q.astype(whitening.High))
    true = np.array([5 + spread * k / 8 for k in range(8)] + [1 + spread * k / 8 for k in range(8)] + [0.1 * k for k in range(1, 9)], whitening.High)
    a = q @ np.diag(true) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.eigen(a)
    order = np.argsort(-true, kind="stable")
    assert np.abs(values - true[order]).max() < 1e-16
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-17
    assert np.abs(a @ vectors - vectors * values).max() < 1e-16
    if spread >= 1e-7:  # single vectors are defined to the accuracy that the gap allows
        assert np.abs(np.abs(np.sum(vectors * q[:, order], axis=0)) - 1).max() < 1e-12


def test_single_precision_alone_would_not_do():
    rng = np.random.default_rng(1)
    b = rng.normal(size=(40, 30))
    a = (b.T @ b).astype(whitening.High)
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(whitening.High)
    s = start.T @ a @ start
    assert np.abs(s - np.diag(np.diag(s))).max() > 1e-7
    values, vectors = whitening.eigen(a)
    s = vectors.T @ a @ vectors
    assert np.abs(s - np.diag(values)).max() < 1e-15


def test_large_entries_are_exact(spark):
    rows = [(i, [1e5 * (i % 7) + 0.25, -1e6 + i]) for i in range(50)]
    found = whitening.fit(frame(spark, rows), "embedding")
    x = whole([v for _, v in rows])
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [[n * sum(r[a] * r[b] for r in x) - sums[a] * sums[b] for b in range(2)] for a in range(2)]
    assert found.scaled.tolist() == exact and [s + n * 100_000 for s in found.sums] == sums


def test_too_large_entries_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        whitening.fit(frame(spark, [(1, [1e10])]), "embedding")


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[], [None, 1.0]]])
def test_no_vectors_no_rows(spark, vectors):
    assert whitening.whiten(frame(spark, list(enumerate(vectors))), "vec_id", "embedding").count() == 0


def test_components_without_variance(spark):
    same = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])]), "vec_id", "embedding").collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["identity_error"] == 0 and r["deviation"] == 0 for r in same)
    line = whitening.whiten(frame(spark, [(k, [k / 1.0, 2.0 * k, 0.0]) for k in range(5)]), "vec_id", "embedding").collect()
    assert {r["component"] for r in line if r["whitened"] is not None} == {1} and max(r["identity_error"] for r in line) < 1e-12
    assert {round(r["explained"], 12) for r in line if r["component"] == 1} == {1.0}
