"""Whitening against a dense eigen decomposition with exact sums."""

import math
import random

import numpy as np
import pytest

from meshtally.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, n bigint, x string, width string"


def plain(vectors):
    """vec_id, n, deviation, components, values, shares and whitened coordinates of one width, from a dense covariance."""
    whole = {i: tuple(math.floor(256 * float(c)) for c in v) for i, v in vectors}
    points = sorted(set(whole.values()))
    n = len(points)
    sums = [sum(p[k] for p in points) for k in range(len(points[0]))]
    d = np.array([[(n * c - s) / n for c, s in zip(p, sums)] for p in points])
    values, y = np.linalg.eigh(d.T @ d / n)
    values, y = values[::-1], y[:, ::-1]
    out = {}
    for i, _ in vectors:
        own = [n * c - s for c, s in zip(whole[i], sums)]
        out[i] = (n, sum(v * v for v in own), np.array([v / n for v in own]) @ y / np.sqrt(np.abs(values) + 1e-300))
    return out, values / values.sum()


def compare(rows, vectors, count):
    want, shares = plain(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(want)
    flips = {}
    for i, (n, deviation, white) in want.items():
        assert sorted(got[i]) == list(range(1, count + 1))
        for k, r in got[i].items():
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert abs(r.explained - shares[k - 1]) < 1e-9
            if abs(white[k - 1]) > 1e-6:
                flips.setdefault(k, set()).add(np.sign(r.whitened * white[k - 1]))
            assert abs(abs(r.whitened) - abs(white[k - 1])) < 1e-7
    assert all(len(f) == 1 for f in flips.values())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    spread = np.linspace(2, 0.2, 12)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=12) * spread + 0.3]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # copies weigh nothing
    return rows


def test_whitening_equals_the_dense_one(spark, vectors):
    bad = [(5000, None), (5001, [1.0] * 11 + [None]), (5002, [float("nan")] * 12), (5003, [float("inf")] + [0.0] * 11), (5004, [])]
    other = [(6000 + i, [float(i % 7), float(i % 3)]) for i in range(40)]
    lone = [(7000, [1.0, 2.0, 3.0]), (7001, [1.0, 2.0, 3.0])]  # one distinct vector: no direction
    frame = spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in [*vectors, *bad, *other, *lone]], SCHEMA).repartition(5)
    rows = whitening.whiten(frame).collect()
    assert all(r.vec_id < 5000 or r.vec_id >= 6000 for r in rows) and not any(r.vec_id >= 7000 for r in rows)
    compare([r for r in rows if r.vec_id < 5000], vectors, 4)
    compare([r for r in rows if r.vec_id >= 6000], other, 2)
    assert whitening.whiten(frame.limit(0)).count() == 0


def test_triangles_join_in_several_rounds(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 16)  # two at a time
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").repartition(9)
    compare(whitening.whiten(frame).collect(), vectors, 4)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i) * 1e15, float(i % 3)]) for i in range(6)]
    found = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert {r.deviation for r in found.values()} == {None} and found[0].n == 6
    d = whitening.scaled_deviations(np.array([[1 << 61], [5]]), 9, np.array([1 << 31]), np.array([7]))
    assert d.tolist() == [[9 * (1 << 61) - (1 << 63) - 7], [45 - (1 << 63) - 7]]


def test_singular_values_and_directions():
    rng, pick = np.random.default_rng(2), random.Random(2)
    for _ in range(150):
        n = pick.randint(1, 25)
        a = rng.normal(size=n) * 10.0 ** rng.integers(-8, 3, size=n) * (rng.random(n) > 0.1)
        b = rng.normal(size=n - 1) * 10.0 ** rng.integers(-10, 3, size=n - 1) * (rng.random(n - 1) > 0.1)
        want = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
        assert np.allclose(np.sqrt(whitening.squared_singular_values(a, b)), want, rtol=1e-12, atol=1e-13 * (want[0] + 1e-300))
    turn = np.linalg.qr(rng.normal(size=(9, 9)))[0]
    close = np.array([3, 3 * (1 - 1e-13), 3 * (1 - 1e-9), 2, 2, 2, 1, 1e-5, 0])
    for r in (np.diag(close) @ turn, rng.normal(size=(4, 9)), np.eye(9), rng.normal(size=(9, 9)) * np.logspace(0, -7, 9)):
        values, y = whitening.leading(np.linalg.qr(r, mode="r"), 4)
        assert np.abs(y.T @ y - np.eye(y.shape[1])).max() < 1e-13
        assert np.abs(r.T @ (r @ y) - y * values).max() < 1e-13 * values[0]
    assert len(whitening.leading(np.zeros((3, 5)), 4)[0]) == 0
