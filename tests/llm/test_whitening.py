"""Whitening against float64 linear algebra on exact sums."""

import numpy as np
import pytest

from feldspark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=16):
    """Rows of (vec_id, vector) by numpy."""
    used = [(i, np.floor(64 * np.asarray(v, float)) + 1_000_000) for i, v in rows]
    fit = np.unique(np.stack([x for _, x in used]), axis=0)
    n, mean = len(fit), fit.mean(axis=0)
    values, vectors = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, fit.shape[1])
    sums = [sum(int(c) for c in col) for col in fit.T]
    return {
        i: (n, sum((n * int(c) - s) ** 2 for c, s in zip(x, sums)), (x - mean) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum())
        for i, x in used
    }


def eigen_case(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    a = (q * np.array(values)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    list(range(1, 65)), list(1 + 1e-9 * np.arange(32)) + list(range(5, 37)), [1] * 20 + [2] * 20 + list(1e-6 * np.arange(20)),
    list(1 + 1e-13 * np.arange(32)), [0] * 10 + [1], [5.0], [3.0] * 7,
])
def test_eigenvectors_to_double_precision(values):
    a = eigen_case(values)
    e, x = W.refined_eigen(a)
    wide = np.longdouble
    al, xl = a.astype(wide), x.astype(wide)
    assert np.abs(al @ xl - xl * e).max() < 1e-14 * np.abs(a).max()
    assert np.abs(xl.T @ xl - np.eye(len(a))).max() < 1e-14
    assert (np.diff(e) <= 0).all() and np.allclose(e, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * np.abs(a).max())
    assert np.abs(np.linalg.eigh(a.astype(np.float32))[1].astype(wide).T @ np.linalg.eigh(a.astype(np.float32))[1] - np.eye(len(a))).max() > 1e-9 or len(a) == 1


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(300, 20)) * np.linspace(3, 0.2, 20)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[7].tolist()) for i in range(150)] + [(7, vectors[9].tolist())]  # copies, and an id again
    bad = [(2000, None), (2001, [float("nan")] * 20), (2002, [None] + [0.0] * 19), (2003, [float("inf")] + [0.0] * 19), (2004, []), (2005, [1.0] * 7)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).repartition(4)
    got = W.whiten(df).collect()
    want = plain([r for r in rows if r[0] != 7] + [(7, vectors[7].tolist())])
    assert len(got) == len(rows) * 16
    seen = {}
    for r in got:
        seen.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for (i, deviation), by in seen.items():
        if i == 7:
            continue
        n, d, y, share = want[i]
        assert (by[1].n, deviation) == (n, d)
        sign = np.sign([by[c].whitened * y[c - 1] for c in range(1, 17)])
        assert np.allclose([abs(by[c].whitened) for c in range(1, 17)], np.abs(y), atol=1e-9) and set(sign) <= {-1, 0, 1}
        assert np.allclose([by[c].explained for c in range(1, 17)], share, rtol=1e-9)
    assert {r.identity_error for r in got}.pop() < 1e-9 and len({r.identity_error for r in got}) == 1
    one_sign = {c: np.sign(sum(by[c].whitened * want[i][2][c - 1] for (i, _), by in seen.items() if i != 7)) for c in range(1, 17)}
    assert all(np.isclose(by[c].whitened, one_sign[c] * want[i][2][c - 1], atol=1e-9) for (i, _), by in seen.items() if i != 7 for c in range(1, 17))


def test_degenerate_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert W.whiten(frame([])).count() == 0
    assert W.whiten(frame([(1, None, 0)])).count() == 0
    assert W.whiten(frame([(1, [1.0, 2.0], 0)] * 5)).count() == 0  # one distinct vector has no variance
    flat = W.whiten(frame([(i, [float(i), 5.0], 0) for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and {r.explained for r in flat} == {1.0}
    null_id = W.whiten(frame([(None, [float(i), float(i * i)], 0) for i in range(9)]))
    assert null_id.where("vec_id IS NULL").count() == 18


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**40 + i * 2**20), float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in W.whiten(df).where("component = 1").collect()}
    want = plain(rows)
    assert got == {i: (want[i][1] if want[i][1] < 1 << 63 else None) for i, _ in rows}
