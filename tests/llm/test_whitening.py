"""Whitening against exact integers and a dense eigensolver; the solver on hard spectra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from yearring.llm.bidiagonal import dqds, right_vectors
from yearring.llm.queries import QUERIES
from yearring.llm.whitening import COMPONENTS, Sums, whitened

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, component int, n string, deviation double"


def matrix_with(values, seed=3):
    rng = np.random.default_rng(seed)
    left, right = (np.linalg.qr(rng.normal(size=(len(values),) * 2))[0] for _ in range(2))
    return np.linalg.qr(left @ np.diag(values) @ right, mode="r")


SPECTRA = {
    "one": [2.0],
    "two": [2.0, 1.0],
    "plain": np.arange(1, 65.0),
    "equal": np.full(40, 3.0),
    "two values": np.r_[np.full(20, 3.0), np.full(44, 1.0)],
    "clusters": np.r_[3 + 1e-9 * np.arange(20), 1 + 1e-13 * np.arange(30)],
    "falling": 10.0 ** -np.arange(0, 12, 0.25),
    "half rank": np.r_[np.arange(1, 33.0), np.zeros(32)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_solver(name):
    m = matrix_with(np.array(SPECTRA[name]))
    values, vectors = right_vectors(m)
    s = np.linalg.svd(m, compute_uv=False)
    assert np.allclose(np.sqrt(values), s, rtol=1e-13, atol=1e-14 * s[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() < 1e-13 * s[0] ** 2


@pytest.mark.parametrize("m", [np.eye(5), np.zeros((4, 4)), np.diag(np.arange(6.0)), np.triu(np.ones((7, 7)))], ids=["eye", "zero", "diagonal", "ones"])
def test_solver_on_special_matrices(m):
    values, vectors = right_vectors(m)
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() < 1e-12 * max(1, values[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11


def test_dqds_keeps_small_values():
    """B = upper bidiagonal with a known determinant: the smallest value keeps its digits."""
    q, e = [1.0, 1e-8, 1e-16, 1e-24], [1e-4, 1e-12, 1e-20]
    found = dqds(q, e)
    assert math.isclose(math.prod(found), math.prod(q), rel_tol=1e-13)


def brute(vectors, limit=COMPONENTS):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    c = (n * (x - 1_000_000) - (s - n * 1_000_000)) / n
    values, base = np.linalg.eigh(c.T @ c / n)
    keep = np.argsort(-values)[:limit]
    return n, deviation, c @ base[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def check(rows, vectors, ids, limit=COMPONENTS):
    n, deviation, w, explained = brute(vectors, limit)
    got = {}
    for r in rows:
        got.setdefault((r.vec_id, r.component), []).append(r)
    assert len(rows) == n * w.shape[1] and max(r.identity_error for r in rows) < 1e-9
    for i, vec_id in enumerate(ids):
        for k in range(w.shape[1]):
            for r in got[vec_id, k + 1]:
                assert (r.n, r.deviation) == (n, deviation[i])
                assert math.isclose(abs(r.whitened), abs(w[i, k]), rel_tol=1e-6, abs_tol=1e-6)
                assert math.isclose(r.explained, explained[k], rel_tol=1e-9)


def test_query(spark, sf):
    source = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(QUERIES["op13_embedding_whitening"](spark, sf).collect(), [r.embedding for r in source], [r.vec_id for r in source])


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 5)) @ np.diag([9, 4, 2, 1, 0.5])
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(7, base[7].tolist())] * 30 + [(1000, [1.0, 2.0]), (1001, [])]
    bad = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0]), (2002, [math.nan] * 5), (2003, [math.inf, 0.0, 0.0, 0.0, 0.0]), (None, None)]
    df = spark.createDataFrame([(*r, 1, "x", 2, "n", 0.0) for r in rows + bad], SCHEMA).repartition(7)
    padded = [v + [0.0] * (5 - len(v)) for _, v in rows]
    check(whitened(df).collect(), padded, [i for i, _ in rows], 5)
    some = whitened(df, 2).collect()
    assert {r.component for r in some} == {1, 2} and len(some) == 2 * len(rows)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [[], []], [None]], ids=["none", "one", "equal", "no entries", "null"])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, "x", 2, "n", 0.0) for i, v in enumerate(vectors)], SCHEMA)
    assert whitened(df).collect() == []


def test_constant_dimensions_have_no_component(spark):
    df = spark.createDataFrame([(i, [float(i), 3.0, float(i % 3), float(i)], 1, "x", 2, "n", 0.0) for i in range(50)], SCHEMA)
    rows = whitened(df).collect()
    assert {r.component for r in rows} == {1, 2} and rows[0].identity_error < 1e-9


def test_deviations_stay_exact():
    y = np.array([[1 << 52, -5], [3, 1 << 40]])
    sums = Sums(2, tuple(int(v) for v in y.sum(axis=0)))
    exact = [sum((2 * int(v) - s) ** 2 for v, s in zip(row, sums.sums)) for row in y]
    assert sums.deviations(y) == [d if d < 1 << 63 else None for d in exact]
    small = np.array([[1 << 20, -5], [3, 7]])
    sums = Sums(2, tuple(int(v) for v in small.sum(axis=0)))
    assert sums.deviations(small) == [sum((2 * int(v) - s) ** 2 for v, s in zip(row, sums.sums)) for row in small]
