"""Whitening of embeddings: float32 eigenvectors of a distributed covariance, refined in higher precision.

Entries become whole numbers (``floor(64 c) + 1000000``), and the distinct vectors of them are the fit list:
its sums are exact and its covariance is summed over tasks after subtracting the rounded mean, so that nothing
cancels. The driver sees sums of one matrix (dimensions squared), never rows.

The eigenvectors come from a float32 solver and are corrected by Ogita and Aishima's iteration: products in
extended precision give the loss of orthogonality R = I - X'X and the coupling S = X'AX, and X moves by X E with
E from R, S and the gaps of the eigenvalues, which converges quadratically. Eigenvalues too close for their gap
to be known form a cluster: within it the iteration only restores orthogonality, and a small solve of the
cluster's own shifted block turns its basis.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are
rows of another length than the commonest (ties: the longer). Entries beyond 2**42 in size count as that size.
Rows that repeat, with or without an id, all come back; a null id stays null. Components whose eigenvalue is zero
to rounding (fewer distinct vectors than dimensions, constant entries) are left out, as they can't be scaled to
variance one. ``deviation`` is null where it exceeds a long. An empty table gives no rows. Other columns play no
part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm.frames import map_batches
from feldspark.session import materialize

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 42)
APART = 1000  # eigenvalues closer than this many times the error bound form a cluster
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vid, x): the usable vectors as whole numbers."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = F.transform(vector, lambda c: F.floor(SCALE * F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c))) + SHIFT)
    return rows.where(usable & (F.size(vector) > 0)).select(F.col(f"`{id_col}`").cast("long").alias("vid"), whole.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def moments(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums by dimension."""

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in source:
            x = _matrix(batch.column(0), d)
            n += len(x)
            for a in range(0, len(x), 4096):  # 4096 entries below 2**49 add up within a long
                total = [s + t for s, t in zip(total, x[a : a + 4096].sum(axis=0).tolist())]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([[str(s) for s in total]], pa.list_(pa.string()))], ["n", "s"]
            )

    part = fit.mapInArrow(add, "n long, s array<string>")
    got = part.select("n", F.posexplode("s").alias("i", "s")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    ).collect()
    by = {r["i"]: r for r in got}
    return (got[0]["n"], [int(by[i]["s"]) for i in range(d)]) if got else (0, [0] * d)


def products(rows: DataFrame, values, k: int) -> np.ndarray:
    """Sum over all vectors of v v' and of v, as a (k, k + 1) matrix; ``values`` turns a matrix of x into rows v.

    Each task adds up its own matrix; the matrices are added entry by entry in a shuffle.
    """

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        some = False
        for batch in source:
            for a in range(0, batch.num_rows, 8192):
                v = values(batch.slice(a, 8192).column(0))
                total += np.column_stack([v.T @ v, v.sum(axis=0)])
                some = True
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k, dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "r"]
            )

    part = rows.mapInArrow(add, "i int, r array<double>").select("i", F.posexplode("r").alias("j", "v"))
    out = np.zeros((k, k + 1))
    for r in part.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of sorted values whose neighbours are no more than ``gap`` apart."""
    ends = np.flatnonzero(np.abs(np.diff(values)) > gap) + 1
    return [c for c in np.split(np.arange(len(values)), ends) if len(c) > 1]


def refined_eigen(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    size = float(np.abs(a).max())
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    wide = np.longdouble
    a = np.asarray(a, wide) / wide(size)
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(wide)
    eye = np.eye(len(a), dtype=wide)
    norm = float(np.linalg.norm(a.astype(np.float64), 2))
    best = math.inf
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # what is left of rounding would be divided by the gaps
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values)
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = float(np.linalg.norm((s - np.diag(values)).astype(np.float64), 2))
        rough = 2 * (off + norm * float(np.linalg.norm(r.astype(np.float64), 2)))
        gap = APART * rough
        apart = values[None, :] - values[:, None]
        known = np.abs(apart) > gap
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(known, (s + values[None, :] * r) / apart, r / 2)
        np.fill_diagonal(step, np.diag(r) / 2)
        x = x + x @ step
        for c in _clusters(values, gap):
            basis = x[:, c]
            middle = values[c].mean()
            block = basis.T @ (a @ basis - middle * basis)
            width = float(np.abs(block).max())
            if width:
                turn = np.linalg.eigh(((block + block.T) / (2 * wide(width))).astype(np.float64))[1][:, ::-1]
                x[:, c] = basis @ turn
        if rough < 1e-17 or (rough < 1e-14 and rough > best / 2):
            break
        best = min(best, rough)
    values = np.diag(x.T @ (a @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values)
    x, values = x[:, order], values[order]
    x = x / np.sqrt((x * x).sum(axis=0))
    top = x[np.abs(x).argmax(axis=0), np.arange(len(a))]
    x = x * np.where(top < 0, -1, 1)
    return (values * wide(size)).astype(np.float64), x.astype(np.float64)


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    usable = whole_vectors(rows, id_col, vector_col)
    common = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not common:
        return spark.createDataFrame([], SCHEMA)
    d = common[0]["d"]
    usable = usable.where(F.size("x") == d)
    fit = materialize(usable.select("x").distinct(), "fit")

    n, sums = moments(fit, d)
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # the mean, rounded
    left = [s - n * int(c) for s, c in zip(sums, near)]
    rest = np.array([s / n for s in left])  # the mean, less that

    found = products(fit, lambda col: (_matrix(col, d) - near).astype(np.float64), d)
    mean = np.array([np.longdouble(s) / n for s in left])
    covariance = found[:, :d].astype(np.longdouble) / n - np.outer(mean, mean)
    covariance = (covariance + covariance.T) / 2
    values, vectors = refined_eigen(covariance)
    trace = float(np.trace(covariance))
    k = int((values[:components] > d * 1e-15 * max(values[0], 0)).sum()) if trace > 0 else 0
    if not k:
        return spark.createDataFrame([], SCHEMA)
    turn = vectors[:, :k] / np.sqrt(values[:k])
    explained = values[:k] / trace

    def project(col: pa.Array) -> np.ndarray:
        return ((_matrix(col, d) - near).astype(np.float64) - rest) @ turn

    of_fit = products(fit, project, k)
    middle = of_fit[:, k] / n
    error = float(np.abs(of_fit[:, :k] / n - np.outer(middle, middle) - np.eye(k)).max())

    def deviations(x: np.ndarray) -> list[int | None]:
        apart = x - near
        if n * (int(np.abs(apart).max(initial=0)) + 1) < (1 << 62) // max(d, 1) and (n * (float(np.abs(apart).max(initial=0)) + 1)) ** 2 * d < 2.0**62:
            return ((n * apart - np.array(left, np.int64)) ** 2).sum(axis=1).tolist()
        exact = (sum((n * c - s) ** 2 for c, s in zip(row, left)) for row in apart.tolist())
        return [v if v < 1 << 63 else None for v in exact]

    def apply(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            y = project(part.column(1))
            m = len(y)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array(deviations(_matrix(part.column(1), d)), pa.int64()).take(at), pa.array(y.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                [f.name for f in fields],
            )

    fields = pa.schema([(c.split()[0], pa.null()) for c in SCHEMA.split(", ")])
    return map_batches(usable.select("vid", "x"), apply, SCHEMA)
