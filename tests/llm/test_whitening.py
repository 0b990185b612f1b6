"""Whitening against numpy's eigen-solver and exact integer arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import whitening as W

VECTORS = "vec_id long, embedding array<double>"


def _brute(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100000
    n, sums = len(x), [sum(map(int, c)) for c in x.T]
    y = x - np.array(sums) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    keep = [j for j in np.argsort(-e)[:k] if e[j] > 1e-9 * e.max()]
    dev = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return n, dev, y @ u[:, keep] / np.sqrt(e[keep]), e[keep] / np.trace(v)


def _check(rows, ids, vectors, k=8):
    n, dev, white, share = _brute(vectors, k)
    assert len(rows) == len(ids) * len(share)
    got = {(r.vec_id, r.component): r for r in rows}
    for c in range(len(share)):
        mine = np.array([got[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.allclose(mine, sign * white[:, c], atol=1e-8)
        assert abs(got[ids[0], c + 1].explained / share[c] - 1) < 1e-9
    assert [got[i, 1].deviation for i in ids] == dev
    assert all(r.n == n and r.identity_error < 1e-8 for r in rows)


def test_whiten_against_eigh(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], VECTORS).repartition(5)
    _check(W.whiten(df).collect(), list(range(400)), vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = rng.normal(size=(60, 4)).tolist()
    bad = [None, [], [1.0, None, 0.0, 0.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0],
           [1.0, 2.0]]
    rows = [(k, v) for k, v in enumerate(good)] + [(100 + k, v) for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("n", F.lit("x")).withColumn("component", F.lit(0))
    _check(W.whiten(df.repartition(3)).collect(), list(range(60)), good)
    doubled = spark.createDataFrame([(None, good[0]), (7, good[1]), (7, good[1]), (8, good[2])], VECTORS)
    out = W.whiten(doubled).collect()
    assert sorted(str(r.vec_id) for r in out if r.component == 1) == ["7", "7", "8", "None"] and out[0].n == 4
    assert {r.component for r in out} == {1, 2}                       # three distinct points have rank two


def test_tables_without_variance(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(k, [3.0, 4.0]) for k in range(9)], [(1, None)]):
        out = W.whiten(spark.createDataFrame(rows, VECTORS))
        assert out.columns == columns and out.count() == 0


def test_float_vectors_and_zero_dimension(spark):
    vectors = [[float(k % 7), 0.0, float(k % 3)] for k in range(50)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    _check(W.whiten(df).collect(), list(range(50)), vectors)


@pytest.mark.parametrize("case", ["random", "equal", "clusters", "diagonal", "block"])
def test_eigen_solver(case):
    rng = np.random.default_rng(9)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = {"random": rng.random(40), "equal": np.array([5.0] * 6 + [1.0] * 34),
              "clusters": np.concatenate([5 + 1e-9 * np.arange(5), 3 + 1e-5 * np.arange(5), rng.random(30)]),
              "diagonal": rng.random(40), "block": rng.random(40)}[case]
    a = q @ np.diag(values) @ q.T if case not in ("diagonal", "block") else np.diag(values)
    if case == "block":
        a[:20, :20] = a[20:, 20:]                                     # every value twice, no coupling
    got, vectors = W.principal((a + a.T) / 2, 8)
    assert np.allclose(got, np.sort(np.linalg.eigvalsh(a))[::-1][:8], atol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(8), atol=1e-11)
    assert np.abs(a @ vectors.T - vectors.T * got).max() < 1e-12


def test_deviation_beyond_64_bits():
    x = np.array([[2 ** 40], [0]], np.int64)
    assert W.deviations(x, 2, [2 ** 40]) == [None, None]
    assert W.deviations(np.array([[5], [2]]), 2, [7]) == [9, 9]
