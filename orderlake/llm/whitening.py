"""PCA whitening of embeddings: distributed centred covariance, Householder
tridiagonalisation, Sturm-count bisection, inverse iteration, projection.

Only d x d numbers (d: the vectors' length) reach the driver, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024.0, 100_000
#: Larger entries have no exact 64-bit value; their rows count as non-finite.
LARGEST = 2.0 ** 52
EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Householder reduction of a symmetric matrix: its diagonal, its
    subdiagonal, and the reflectors H_k = I - 2 v v' with H_k..H_0 A H_0..H_k = T."""
    a = np.array(a, float)
    d = len(a)
    reflectors: list[np.ndarray | None] = []
    for k in range(d - 2):
        x = a[k + 1:, k]
        tail = np.abs(x[1:]).max()
        if tail == 0:
            reflectors.append(None)
            continue
        v = x / np.abs(x).max()
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        reflectors.append(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        q = p - (v @ p) * v
        rest -= 2 * (np.outer(v, q) + np.outer(q, v))
        a[k + 1, k] = x[0] - 2 * v[0] * (v @ x)
        a[k + 2:, k] = 0
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def back(vectors: np.ndarray, reflectors: list[np.ndarray | None]) -> np.ndarray:
    """Eigenvectors (columns) of T carried back to those of the full matrix."""
    out = vectors.copy()
    for k in reversed(range(len(reflectors))):
        v = reflectors[k]
        if v is not None:
            out[k + 1:] -= 2 * np.outer(v, v @ out[k + 1:])
    return out


def sturm(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every x of ``at``: how many eigenvalues of T are below x (the
    negative pivots of T - xI)."""
    floor = np.finfo(float).tiny * max(1.0, float((off ** 2).max(initial=0)))
    below = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for k in range(len(diag)):
        q = diag[k] - at - (off[k - 1] ** 2 / q if k else 0)
        q = np.where(np.abs(q) < floor, -floor, q)
        below += q < 0
    return below


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of T, falling, by bisection on Sturm counts."""
    d = len(diag)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low, high = float((diag - reach).min()), float((diag + reach).max())
    pad = 2 * EPS * max(abs(low), abs(high)) + np.finfo(float).tiny
    lo, hi = np.full(k, low - pad), np.full(k, high + pad)
    rank = d - 1 - np.arange(k)                 # the j-th largest has d - 1 - j below it
    for _ in range(120):
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        above = sturm(diag, off, mid) > rank
        hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)
    return lo + (hi - lo) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift I) x = b by elimination with row exchanges; a pivot is at least ``floor``."""
    d = len(diag)
    u, w, z, b = diag - shift, np.zeros(d), np.zeros(d), b.copy()
    w[:d - 1] = off
    for k in range(d - 1):
        low = off[k]
        if abs(low) > abs(u[k]):                # rows k and k + 1 change places
            m = u[k] / low
            u[k], w_k, z_k = low, u[k + 1], w[k + 1]
            u[k + 1], w[k + 1] = w[k] - m * w_k, -m * z_k
            w[k], z[k] = w_k, z_k
            b[k], b[k + 1] = b[k + 1], b[k] - m * b[k + 1]
        else:
            if abs(u[k]) < floor:
                u[k] = floor
            m = low / u[k]
            u[k + 1] -= m * w[k]
            b[k + 1] -= m * b[k]
    if abs(u[-1]) < floor:
        u[-1] = floor
    x = np.zeros(d)
    for k in reversed(range(d)):
        x[k] = (b[k] - (w[k] * x[k + 1] if k + 1 < d else 0) - (z[k] * x[k + 2] if k + 2 < d else 0)) / u[k]
    return x


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of T; within a cluster (neighbours closer
    than a thousandth of the norm) each is made orthogonal to those before it."""
    d = len(diag)
    norm = max(float(np.abs(diag).max()), float(np.abs(off).max(initial=0)), np.finfo(float).tiny)
    rng = np.random.default_rng(d)
    out, start, used = np.zeros((d, len(values))), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            start = j
        shift = min(value, used - 10 * EPS * norm) if j > start else value    # equal values: apart by a hair
        used = shift
        x = rng.standard_normal(d)
        for _ in range(5):
            for _ in range(2):
                x -= out[:, start:j] @ (out[:, start:j].T @ x)
            x /= np.abs(x).max()
            x = _solve(diag, off, shift, x, EPS * norm)
            x /= np.abs(x).max()
            x /= np.sqrt(x @ x)
        for _ in range(2):
            x -= out[:, start:j] @ (out[:, start:j].T @ x)
            x /= np.sqrt(x @ x)
        out[:, j] = x
    return out


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the at most k leading eigenvalues of a
    covariance that are above its rounding error; each vector's largest entry is
    positive."""
    scale = float(np.abs(v).max(initial=0))
    if scale == 0:
        return np.zeros(0), np.zeros((0, len(v)))
    diag, off, reflectors = tridiagonal(v / scale)
    values = leading_values(diag, off, min(k, len(v)))
    values = values[values > len(v) * EPS * max(values[0], 0)]
    vectors = back(inverse_iteration(diag, off, values), reflectors).T
    signs = np.sign(vectors[np.arange(len(values)), np.abs(vectors).argmax(axis=1)])
    return values * scale, vectors * signs[:, None]


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    """The x-vectors of a batch, as whole numbers."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)).astype(np.int64) + SHIFT


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for b in batches:
            x = _matrix(b.column(0), d)
            low += (x & 0xFFFFFF).sum(axis=0)
            high += (x >> 24).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(low), pa.array(high),
                                          pa.array([n] * d, pa.int64())], ["dim", "low", "high", "n"])
    return run


def _products(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(mean)
        total = np.zeros((d, d))
        for b in batches:
            y = _matrix(b.column(0), d) - mean
            total += y.T @ y
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "s"])
    return run


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum (n x - S)^2 of each row, exact; null where it is no 64-bit number."""
    base = [s // n for s in sums]
    rest = np.array([s - n * b for s, b in zip(sums, base, strict=True)], np.int64)
    y = x - np.array(base, np.int64)
    reach = n * (float(np.abs(y).max(initial=0)) + 1)
    if reach * reach * x.shape[1] < 2.0 ** 62:
        return ((n * y - rest) ** 2).sum(axis=1).tolist()
    exact = ((n * y.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
    return [int(t) if t < 1 << 63 else None for t in exact]


def _projected(n: int, sums: list[int], mean: np.ndarray, axes: np.ndarray, roots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), len(mean))
            w = (x - mean) @ axes.T / roots
            lists = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), len(axes)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviations(x, n, sums), pa.int64()), lists],
                                             ["vec_id", "deviation", "w"])
    return run


def whiten(rows: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of every usable vector on the k leading components.

    One row per vector and component: vec_id, component (from 1, by falling
    eigenvalue), n, deviation, whitened, explained, identity_error.  An entry c
    counts as floor(1024 c) + 100000.  Rows are left out whose vector is null or
    empty, or has a null, non-finite or inexact entry (1024 |c| over 2^52), or
    another length than most vectors have (ties: the longest).  Repeated rows
    and ids stay, each in the fit and in the result; null ids stay null; other
    columns are ignored.  Components of no variance are left out, so equal
    vectors, one vector or an empty table give no rows.  A deviation that is no
    64-bit number is null.  Three passes over the written usable rows; the
    driver reads d sums and d (d + 1) / 2 products.
    """
    spark = rows.sparkSession
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    usable = F.forall("vec", lambda c: F.coalesce(F.abs(c) * SCALE <= LARGEST, F.lit(False)) & ~F.isnan(c))
    clean = stored(rows.select(F.col(f"`{id_col}`").alias("vec_id"), vec.alias("vec"))
                   .filter(F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(usable), "whiten-vectors")
    out_type = f"vec_id {clean.schema['vec_id'].dataType.simpleString()}, deviation long, w array<double>"
    length = clean.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d, n, values, axes = 1, 1, np.zeros(0), np.zeros((0, 1))
    sums, mean, trace = [0], np.zeros(1), 1.0
    if length is not None:
        d, n = length["d"], length["count"]
        fit = clean.filter(F.size("vec") == d)
        parts = fit.select("vec").mapInArrow(_sums(d), "dim int, low long, high long, n long")
        exact = "decimal(38,0)"
        totals = parts.groupBy("dim").agg(F.sum(F.col("low").cast(exact)).alias("low"),
                                          F.sum(F.col("high").cast(exact)).alias("high")).orderBy("dim").collect()
        sums = [int(t["low"]) + (int(t["high"]) << 24) for t in totals]
        mean = np.array([float(Fraction(s, n)) for s in sums])
        cells = (fit.select("vec").mapInArrow(_products(mean), "i int, j int, s double")
                 .groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas())
        v = np.zeros((d, d))
        v[cells.i, cells.j] = v[cells.j, cells.i] = cells.s / n
        trace = float(np.trace(v))
        values, axes = principal(v, k)
    if not len(values):
        none = spark.createDataFrame([], out_type)
        return none.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in _TYPES])
    white = stored(fit.select("vec_id", "vec").mapInArrow(
        _projected(n, sums, mean, axes, np.sqrt(values)), out_type), "whiten-projected")
    m = len(values)
    means = white.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(m)]).first()
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    cov = white.agg(*[F.avg((F.col("w")[i] - means[i]) * (F.col("w")[j] - means[j])).alias(f"c{i}_{j}")
                      for i, j in pairs]).first()
    error = max(abs(cov[p] - (i == j)) for p, (i, j) in enumerate(pairs))
    share = F.array(*[F.lit(float(e / trace)) for e in values])
    return white.select("vec_id", "deviation", F.posexplode("w").alias("pos", "whitened")).select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("pos")].alias("explained"), F.lit(float(error)).alias("identity_error"))


_TYPES = [("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
          ("explained", "double"), ("identity_error", "double")]
