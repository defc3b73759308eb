"""Embedding whitening: exact distributed covariance, own symmetric eigen-solver, projection in the rows.

The covariance is summed on Spark as exact integers: every task multiplies its
block of quantised vectors once and hands on one row per matrix entry, and the
entries are added as ``decimal(38,0)``. Only the d x d matrix reaches the driver
(d is the width of a vector, not a count of rows). There it is reduced to a
tridiagonal matrix by Householder reflections, its leading eigenvalues are
found by bisection on Sturm counts, and their vectors by inverse iteration,
reorthogonalised within clusters of close eigenvalues. The components go back
into the plan as literals and every row is projected by built-in expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
# An eigenvalue at or below this share of the trace has no direction to whiten.
LEAST_SHARE = 1e-12
# Bisection stops when the interval is this many units in the last place wide.
ULPS = 4
# Eigenvalues closer than this share of the spectrum's width are one cluster.
CLUSTER = 1e-3


# ---------------------------------------------------------------- the solver


def tridiagonalize(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(diag, off, q)`` with ``q.T @ a @ q`` tridiagonal, by Householder reflections."""
    a = np.array(a, dtype=np.float64)
    d = a.shape[0]
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        alpha = -math.copysign(norm, x[0])
        v = x
        v[0] -= alpha
        v /= np.linalg.norm(v)
        # a <- H a H with H = I - 2 v v^T acting on rows and columns k+1..
        a[k + 1 :, :] -= 2.0 * np.outer(v, v @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2.0 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ v, v)
    diag = np.diag(a).copy()
    off = np.array([a[i + 1, i] for i in range(d - 1)])
    return diag, off, q


def sturm_count(diag: np.ndarray, off: np.ndarray, x: float) -> int:
    """Number of eigenvalues of the tridiagonal matrix below ``x``."""
    count, q = 0, 1.0
    tiny = np.finfo(np.float64).tiny
    for i in range(len(diag)):
        b2 = off[i - 1] ** 2 if i else 0.0
        q = diag[i] - x - (b2 / q if i else 0.0)
        if q == 0.0:
            q = -tiny
        if q < 0.0:
            count += 1
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, falling, by bisection on Sturm counts."""
    d = len(diag)
    if d == 0:
        return []
    radius = np.zeros(d)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    low, high = float(np.min(diag - radius)), float(np.max(diag + radius))
    width = max(abs(low), abs(high), np.finfo(np.float64).tiny)
    found = []
    for j in range(min(k, d)):
        # The (j+1)-th largest is the (d-j)-th smallest: the point where d-j-1 lie below.
        lo, hi = low, high
        while hi - lo > ULPS * np.finfo(np.float64).eps * max(abs(lo), abs(hi), width * 1e-300):
            mid = 0.5 * (lo + hi)
            if mid in (lo, hi):
                break
            if sturm_count(diag, off, mid) > d - j - 1:
                hi = mid
            else:
                lo = mid
        found.append(0.5 * (lo + hi))
    return found


def _solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray) -> np.ndarray:
    """Solve ``(T - shift I) y = rhs`` by Gaussian elimination with partial pivoting on the band."""
    d = len(diag)
    if d == 1:
        p = diag[0] - shift
        return rhs / (p if p != 0.0 else np.finfo(np.float64).eps)
    # Rows as (main, upper, upper2) after pivoting may fill one extra upper diagonal.
    m = np.zeros((d, 3))
    m[:, 0] = diag - shift
    m[:-1, 1] = off
    low = np.concatenate([off, [0.0]])
    b = rhs.astype(np.float64).copy()
    eps = np.finfo(np.float64).eps * max(1.0, float(np.max(np.abs(diag)) + np.max(np.abs(off))))
    for i in range(d - 1):
        sub = low[i]
        if abs(sub) > abs(m[i, 0]):
            # Swap row i and i+1: row i+1 is (sub, diag, off) at columns i, i+1, i+2.
            nxt = np.array([sub, m[i + 1, 0], m[i + 1, 1]])
            cur = np.array([m[i, 0], m[i, 1], m[i, 2]])
            m[i] = nxt
            b[i], b[i + 1] = b[i + 1], b[i]
            factor = cur[0] / nxt[0]
            m[i + 1, 0] = cur[1] - factor * nxt[1]
            m[i + 1, 1] = cur[2] - factor * nxt[2]
            m[i + 1, 2] = 0.0
        else:
            pivot = m[i, 0] if m[i, 0] != 0.0 else eps
            m[i, 0] = pivot
            factor = sub / pivot
            m[i + 1, 0] -= factor * m[i, 1]
            m[i + 1, 1] -= factor * m[i, 2]
        b[i + 1] -= factor * b[i]
    if m[d - 1, 0] == 0.0:
        m[d - 1, 0] = eps
    y = np.zeros(d)
    for i in range(d - 1, -1, -1):
        s = b[i]
        if i + 1 < d:
            s -= m[i, 1] * y[i + 1]
        if i + 2 < d:
            s -= m[i, 2] * y[i + 2]
        y[i] = s / m[i, 0]
    return y


def eigen_pairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix.

    Signs: the entry of largest magnitude of each vector is positive (the first such on ties).
    """
    diag, off, q = tridiagonalize(v)
    values = leading_eigenvalues(diag, off, k)
    d = len(diag)
    span = (max(values) - min(values)) if values else 0.0
    scale = max(span, abs(values[0]) if values else 0.0, np.finfo(np.float64).tiny)
    vectors: list[np.ndarray] = []
    rng = np.random.default_rng(7)
    for j, e in enumerate(values):
        cluster = [vectors[i] for i in range(j) if abs(values[i] - e) <= CLUSTER * scale]
        # Nudge the shift so that T - shift I is not singular to the last bit.
        shift = e + 8 * np.finfo(np.float64).eps * scale * (1 + len(cluster))
        y = rng.standard_normal(d)
        for _ in range(4):
            y = _solve_shifted(diag, off, shift, y)
            for u in cluster:
                y -= (u @ y) * u
            norm = np.linalg.norm(y)
            if norm == 0.0 or not np.isfinite(norm):
                y = rng.standard_normal(d)
                continue
            y /= norm
        vectors.append(y)
    if not vectors:
        return np.array([]), np.zeros((d, 0))
    full = q @ np.column_stack(vectors)
    for c in range(full.shape[1]):
        full[:, c] /= np.linalg.norm(full[:, c])
        top = int(np.argmax(np.abs(full[:, c])))
        if full[top, c] < 0:
            full[:, c] = -full[:, c]
    return np.array(values), full


# ---------------------------------------------------------------- on Spark


def fit_rows(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(vec_id, y)``: rows kept for the fit, ``y`` = floor(1024 c) per entry (x = y + 100000).

    Dropped: a null vector, a vector with a null, NaN or infinite entry, and a
    vector whose length is not the most common length of the kept vectors
    (ties: the greater length). Repeated rows all count; a null ``vec_id`` is
    kept as a row of its own.
    """
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    ok = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).alias("v")).where(F.col("v").isNotNull() & ~bad)
    ok = ok.select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("y"))
    staged = stage(ok, "whiten-rows")
    sizes = staged.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    width = sizes["d"] if sizes else 0
    return staged.where(F.size("y") == width), width


def _partial_sums(rows: DataFrame, width: int) -> DataFrame:
    """``(i, j, s)``: per task, n at (-1, -1), sums of y at (-1, j), sums of y_i y_j at (i, j >= i), as text."""
    guard = 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        sums = [0] * width
        cross = np.zeros((width, width), dtype=object)
        for batch in batches:
            col = batch.column(0)
            if batch.num_rows == 0:
                continue
            y = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, width)
            n += batch.num_rows
            sums = [s + int(t) for s, t in zip(sums, y.sum(axis=0, dtype=object))]
            top = int(np.abs(y).max()) if y.size else 0
            # Rows per block such that no int64 sum of products can overflow.
            step = max(1, guard // max(1, top * top)) if top else batch.num_rows
            for start in range(0, batch.num_rows, step):
                block = y[start : start + step]
                if top and top * top > guard:
                    cross += block.astype(object).T @ block.astype(object)
                else:
                    cross += (block.T @ block).astype(object)
        if n == 0:
            return
        i_s, j_s, vals = [-1], [-1], [str(n)]
        for j in range(width):
            i_s.append(-1), j_s.append(j), vals.append(str(sums[j]))
            for i in range(j, width):
                i_s.append(j), j_s.append(i), vals.append(str(int(cross[j, i])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i_s, pa.int32()), pa.array(j_s, pa.int32()), pa.array(vals, pa.string())], names=["i", "j", "s"]
        )

    return rows.select("y").mapInArrow(run, "i int, j int, s string")


def covariance_sums(rows: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """Exact ``(n, S_y, sum of y y^T)`` over all rows: integer partials added as decimals on Spark."""
    total = (
        _partial_sums(rows, width)
        .groupBy("i", "j")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"))
        .collect()
    )
    n = 0
    sums = [0] * width
    cross = [[0] * width for _ in range(width)]
    for r in total:
        value = int(r["s"])
        if r["i"] == -1 and r["j"] == -1:
            n = value
        elif r["i"] == -1:
            sums[r["j"]] = value
        else:
            cross[r["i"]][r["j"]] = cross[r["j"]][r["i"]] = value
    return n, sums, cross


def _dot(values, weights: list[float]):
    return F.aggregate(F.zip_with(values, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)


def whiten(embeddings: DataFrame, k: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Whiten all usable vectors against their own covariance.

    Returns for each kept row and each of the first ``k`` components:
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    * x = floor(1024 c) + 100000 per entry; n rows, sums S per dimension.
    * V = covariance of x over all kept rows, divisor n, exact (integers).
    * ``deviation`` = sum over dimensions of (n x - S)^2, exact, as a long.
    * ``whitened`` = (x - S/n) . u / sqrt(e) for component u with eigenvalue e.
    * ``explained`` = e / trace(V); ``identity_error`` = largest absolute entry
      of the covariance of the whitened values minus the identity (one value).

    Edge cases: rows dropped as in ``fit_rows``; no kept rows, or a zero
    covariance, give no rows; components with e at or below 1e-12 of the trace
    are not returned (no direction to whiten). Components are signed so that the
    largest entry is positive. Extra columns of ``embeddings`` are ignored.
    """
    rows, width = fit_rows(embeddings, vector, key)
    n, sums, cross = covariance_sums(rows, width) if width else (0, [], [])
    empty = rows.sparkSession.createDataFrame(
        [], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    if n == 0:
        return empty
    # n^2 V = n * sum(y y^T) - S S^T, exactly; the shift by 100000 cancels.
    numer = [[n * cross[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    v = np.array([[numer[i][j] / (n * n) for j in range(width)] for i in range(width)], dtype=np.float64)
    trace = float(sum(numer[i][i] for i in range(width)) / (n * n))
    if trace <= 0.0:
        return empty
    values, vectors = eigen_pairs(v, min(k, width))
    keep = [c for c in range(len(values)) if values[c] > LEAST_SHARE * trace]
    if not keep:
        return empty
    means = [s / n for s in sums]
    centred = F.zip_with("y", F.array(*[F.lit(float(m)) for m in means]), lambda y, m: y.cast("double") - m)
    proj = F.array(*[_dot(centred, list(vectors[:, c] / math.sqrt(values[c]))) for c in keep])
    dev = F.aggregate(
        F.zip_with("y", F.array(*[F.lit(s).cast("decimal(38,0)") for s in sums]), lambda y, s: F.pow(F.lit(n).cast("decimal(38,0)") * y - s, 2).cast("decimal(38,0)")),
        F.lit(0).cast("decimal(38,0)"),
        lambda a, b: (a + b).cast("decimal(38,0)"),
    )
    projected = stage(rows.select("vec_id", proj.alias("w"), dev.cast("bigint").alias("deviation")), "whiten-projected")
    identity = _identity_error(projected, len(keep), n)
    share = F.array(*[F.lit(float(values[c] / trace)) for c in keep])
    return projected.select(
        "vec_id",
        F.posexplode("w").alias("pos", "whitened"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
    ).select(
        "vec_id",
        (F.col("pos") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at(share, F.col("pos") + 1).alias("explained"),
        F.lit(identity).alias("identity_error"),
    )


def _identity_error(projected: DataFrame, k: int, n: int) -> float:
    """Largest |cov(w_a, w_b) - [a == b]| over the fit list, each sum a partial aggregate."""
    parts = [F.sum(F.element_at("w", a + 1)).alias(f"s{a}") for a in range(k)]
    parts += [F.sum(F.element_at("w", a + 1) * F.element_at("w", b + 1)).alias(f"p{a}_{b}") for a in range(k) for b in range(a, k)]
    got = projected.agg(*parts).first()
    worst = 0.0
    for a in range(k):
        for b in range(a, k):
            cov = got[f"p{a}_{b}"] / n - (got[f"s{a}"] / n) * (got[f"s{b}"] / n)
            worst = max(worst, abs(cov - (1.0 if a == b else 0.0)))
    return worst
