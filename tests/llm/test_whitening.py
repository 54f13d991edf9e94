"""Whitening against eigenvectors of an exactly computed covariance."""

import math
import random

import numpy as np
import pytest

from voltlake.llm import queries, whitening


def exact(vectors, most=32):
    """n, exact deviations, eigenvalues, components and whitened rows, the covariance in whole numbers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(d)]
    off = [[n * row[j] - sums[j] for j in range(d)] for row in x]
    cov = [[sum(r[i] * r[j] for r in off) for j in range(d)] for i in range(d)]
    cov = np.array([[float(v) / n**3 for v in row] for row in cov])
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1], parts[:, ::-1]
    rank = np.linalg.matrix_rank(cov, tol=1e-12 * values[0], hermitian=True) if values[0] > 0 else 0
    k = min(most, rank)
    whitened = np.array(off, dtype=float) / n @ parts[:, :k] / np.sqrt(values[:k])
    return n, [total if (total := sum(v * v for v in r)) < 1 << 63 else None for r in off], values, values[:k] / values.sum(), whitened


def compared(found, vectors, most=32):
    n, deviations, values, explained, whitened = exact(vectors, most)
    k = len(explained)
    assert len(found) == len(vectors) * k
    by = {}
    for r in found:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert {tuple(sorted(c)) for c in by.values()} <= {tuple(range(1, k + 1))}
    ours = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in range(len(vectors))])
    for i, parts in by.items():
        assert all(r.n == n and r.deviation == deviations[i] for r in parts.values())
        assert [parts[c].explained for c in range(1, k + 1)] == pytest.approx(list(explained), rel=1e-9)
    assert all(r.identity_error < 1e-8 for r in found)
    # Components of clearly different eigenvalues are unique up to their sign.
    gaps = np.abs(np.diff(np.append(values, 0)))[:k] / values[0]
    apart = [c for c in range(k) if gaps[c] > 1e-6 and (c == 0 or gaps[c - 1] > 1e-6)]
    signs = np.sign((ours * whitened).sum(axis=0))
    assert np.allclose(ours[:, apart], (whitened * signs)[:, apart], atol=1e-6)
    assert np.allclose(ours.T @ ours / n, np.eye(k), atol=1e-8)


def frame(spark, vectors, kind="float"):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def test_given_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    place = {r.vec_id: i for i, r in enumerate(table)}
    found = queries.op12_whitening(spark, sf_dir).collect()
    moved = [r.__class__(**{**r.asDict(), "vec_id": place[r.vec_id]}) for r in found]
    compared(moved, [r.embedding for r in table])


@pytest.mark.parametrize("case", ["plain", "far", "scaled", "dependent", "few", "copies"])
def test_hard_tables(spark, case):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 10)) * np.arange(1, 11)
    if case == "far":
        base = base + 1e7
    if case == "scaled":
        base = base * np.logspace(0, 2, 10)
    if case == "dependent":
        base = np.floor(base * 64) / 64
        base = np.hstack([base, base[:, :1], base[:, 1:2] + base[:, 2:3], np.full((300, 1), 7.0)])
    if case == "few":
        base = base[:6]
    if case == "copies":
        base = np.vstack([base[:20], np.repeat(base[20:21], 200, axis=0)])
    compared(whitening.whiten(frame(spark, base.tolist(), "double").repartition(7)).collect(), base.tolist())


def test_odd_rows(spark):
    good = [[random.Random(i * 3 + j).random() for j in range(3)] for i in range(40)]
    odd = [None, [1.0, None, 2.0], [float("nan"), 1, 1], [float("inf"), 1, 1], [1e300, 1, 1], [], [1.0, 2.0], [None] * 3]
    table = frame(spark, good + odd, "double").selectExpr("vec_id", "embedding", "1 AS n", "2 AS x", "'a' AS part", "3 AS component")
    compared(whitening.whiten(table).collect(), good)
    assert len(whitening.whiten(table, most=2).collect()) == 80
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(frame(spark, odd[:2])).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).collect() == []  # nothing differs
    twice = whitening.whiten(table.union(table).withColumn("vec_id", table.vec_id * 0)).collect()
    assert len(twice) == 240 and {r.n for r in twice} == {80}


def test_deviations_beyond_long():
    x = np.array([[1 << 40, 0], [0, 0], [5, 5]], dtype=np.int64)
    found = whitening.deviations(x, 3, x.sum(axis=0))
    assert found[0] is None and found == [None, None, None]
    small = np.array([[1 << 30, 0], [0, 3]], dtype=np.int64)
    assert whitening.deviations(small, 2, small.sum(axis=0)) == [(1 << 60) + 9] * 2


def test_triangles():
    rng = np.random.default_rng(1)
    triangle = np.triu(rng.normal(size=(6, 6))) + 3 * np.eye(6)
    rows = rng.normal(size=(9, 6))
    assert np.allclose(whitening.solved(rows, triangle) @ triangle, rows)
    a = rng.normal(size=(50, 4))
    a = np.hstack([a, a[:, :2] @ rng.normal(size=(2, 2))])
    factor, pivots = whitening.pivoted_cholesky(a.T @ a, 1e-8)
    assert len(pivots) == 4 and np.allclose(factor.T @ factor, a.T @ a)
    assert np.allclose(np.tril(factor[:, pivots], -1), 0)
