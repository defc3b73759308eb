"""Whitening against a plain restatement in numpy on the given table, and on odd rows."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from termlake.llm import whitening
from termlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def restate(vectors):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], dtype=np.int64)
    n = len(x)
    s = x.sum(axis=0)
    dev = [sum(int(n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    z = x - s / n
    v = (z.T @ z) / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(e)[::-1][:8]
    return n, dev, z, e[order], u[:, order], np.trace(v)


def test_query_matches_numpy(scratch):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    n, dev, z, e, u, trace = restate([r["embedding"] for r in table])
    rows = QUERIES["op12_whitening"](scratch, SF).collect()
    assert len(rows) == 8 * len(table)
    ids = {r["vec_id"]: i for i, r in enumerate(table)}
    for r in rows:
        i, c = ids[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == dev[i]
        want = z[i] @ u[:, c] / math.sqrt(e[c])
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-6 * max(1, abs(want))
        assert abs(r["explained"] - e[c] / trace) <= 1e-4 * e[c] / trace
        assert r["identity_error"] <= 1e-4
    # One sign per component for all rows.
    for c in range(8):
        got = np.array([r["whitened"] for r in sorted(rows, key=lambda r: ids[r["vec_id"]]) if r["component"] == c + 1])
        want = z @ u[:, c] / math.sqrt(e[c])
        assert np.allclose(got, want, atol=1e-6) or np.allclose(got, -want, atol=1e-6)


def test_odd_rows(scratch):
    rows = [
        (1, [0.5, 0.25, -1.0]),
        (2, [0.1, 0.2, 0.3]),
        (2, [0.1, 0.2, 0.3]),
        (None, [-0.7, 0.0, 0.9]),
        (3, None),
        (4, [0.1, None, 0.2]),
        (5, [float("nan"), 0.0, 0.0]),
        (6, [float("inf"), 0.0, 0.0]),
        (7, [1.0, 2.0]),
        (8, [2.0, -3.0, 0.125]),
    ]
    df = scratch.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("n", whitening.F.lit("x"))
    got = whitening.whiten(df).collect()
    assert {r["vec_id"] for r in got} == {1, 2, None, 8}
    assert len(got) == 3 * 5 and {r["n"] for r in got} == {5}
    assert all(r["identity_error"] < 1e-9 for r in got)
    empty = scratch.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(empty).count() == 0
    same = scratch.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(same).count() == 0


@pytest.mark.parametrize("lam", [[5, 5, 5, 2, 1, 1, 0.5, 0.1], [1e6, 1, 1e-6, 0, 0, 0]])
def test_solver_on_clusters(lam):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((len(lam), len(lam))))
    v = q @ np.diag(lam) @ q.T
    e, u = whitening.eigen_pairs(v, 4)
    assert np.allclose(e, sorted(lam, reverse=True)[:4], rtol=1e-12, atol=1e-9)
    assert np.abs(u.T @ u - np.eye(4)).max() < 1e-12
    assert np.abs(v @ u - u * e).max() < 1e-9 * max(lam)
