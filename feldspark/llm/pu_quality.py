"""Quality scores by positive-unlabelled learning with the non-negative risk.

A linear model on text figures is fitted by minimising

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)])

with the logistic loss: P are trusted positives, U is unlabelled text (rows of the whole table outside the
held-out fold, labelled or not, every label hidden) and ``prior`` the share of positives in it. The prior is
estimated from P and U alone: among the best scores of a first model U holds the prior times what P holds, so the
least ratio of the two, with a bound for chance, is the share. While the bracket is negative only its own
gradient is followed upwards, as the non-negative estimator prescribes. Negative labels are used for nothing.

The figures (shares of kinds of characters, word and line repetition, lengths) come from one
pass over all whole texts and are stored; fitting takes at most ``sample`` positives and ``sample``
unlabelled rows, picked by the smallest hash of the id. Every row is scored.

Null and empty texts have figures of zero and a score like any other. Rows that repeat a doc_id are
each scored; an id that is labelled twice counts by its mean label. Without any positive label all
scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import id_and_text, map_batches, real_id
from feldspark.session import materialize

SAMPLE = 20_000
THRESHOLD = 0.7
STEPS = 400
RATE = 0.5
DECAY = 1e-4
# kinds of bytes
_KIND = np.full(256, 8, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3
_KIND[[32, 9, 11, 12, 13]], _KIND[10] = 4, 5
_KIND[list(b".,;:!?'\"()-")] = 6
_KIND[list(b"#*$%&|<>")] = 7
N_KINDS = 9


def figures(texts: list[bytes]) -> np.ndarray:
    """One row of figures per text."""
    _, data, lo, hi = arrays.joined(texts)
    starts, ends = arrays.word_bounds(data)
    prefix = arrays.prefix_hash(data)
    words = arrays.slice_hash(prefix, starts, ends)
    first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    kind = _KIND[data]
    out = np.zeros((len(texts), N_KINDS + 8))
    for i, (a, b, p, q) in enumerate(zip(lo.tolist(), hi.tolist(), first.tolist(), last.tolist())):
        if q == p:
            continue
        n, size = q - p, b - a
        held = np.sort(words[p:q])
        new = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        most = np.diff(np.append(new, n)).max()
        length = (ends[p:q] - starts[p:q]).astype(float)
        lines = texts[i].split(b"\n")
        out[i, :N_KINDS] = np.bincount(kind[a:b], minlength=N_KINDS) / size
        out[i, N_KINDS:] = (
            np.log1p(n), len(new) / n, np.log(len(new)) / np.log(n + 1), most / n, length.mean(), length.std(), np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines),
        )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return expand((x - self.mean) / self.scale) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def expand(z: np.ndarray) -> np.ndarray:
    """Each figure bent in both directions, so that both ends of its range can count against a text."""
    z = np.clip(z, -5, 5)
    return np.concatenate([z, np.abs(z)], axis=1)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model:
    """Minimise the non-negative risk by gradient steps with momentum."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale == 0] = 1
    p, u = expand((positive - mean) / scale), expand((unlabelled - mean) / scale)
    w, b = np.zeros(p.shape[1]), 0.0
    vw, vb = np.zeros_like(w), 0.0
    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    for _ in range(steps):
        fp, fu = p @ w + b, u @ w + b
        bracket = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp, gu = sigmoid(fp) / len(p), sigmoid(fu) / len(u)
        negative_w, negative_b = u.T @ gu - prior * (p.T @ gp), gu.sum() - prior * gp.sum()
        if bracket >= 0:
            pull = (sigmoid(fp) - 1) / len(p)
            gw, gb = prior * (p.T @ pull) + negative_w, prior * pull.sum() + negative_b
        else:
            gw, gb = -negative_w, -negative_b
        vw, vb = 0.9 * vw - rate * (gw + decay * w), 0.9 * vb - rate * gb
        w, b = w + vw, b + vb
    return Model(mean, scale, w, float(b))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 2, chance: float = 1e-3) -> float:
    """Share of positives in unlabelled text, from the two samples alone.

    A model is fitted on one half of both; on the other half the share of U above a threshold is at least the prior
    times that of P, and equals it where nothing negative scores as high. The threshold of least ratio counts, each
    ratio with the error that samples of these sizes may have; the halves change places and both results are averaged.
    """
    prior = 0.5
    if min(len(positive), len(unlabelled)) < 4:
        return prior
    for _ in range(rounds):
        found = []
        for k in (0, 1):
            model = fit(positive[k::2], unlabelled[k::2], prior)
            p, u = np.sort(model.margin(positive[1 - k :: 2])), np.sort(model.margin(unlabelled[1 - k :: 2]))
            cut = np.quantile(p, np.arange(51) / 100)  # thresholds that at least half of P passes
            above_p, above_u = (1 - np.searchsorted(held, cut) / len(held) for held in (p, u))
            ratio = above_u / above_p
            error = np.sqrt(np.log(4 / chance) / 2) * (len(u) ** -0.5 + ratio * len(p) ** -0.5) / above_p
            found.append(ratio[np.argmin(ratio + error)])
        prior = float(np.clip(np.mean(found), 0.01, 0.99))
    return prior


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a missing id is in no class."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def labelled(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, y) with one row per labelled id."""
    return labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        (F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y")
    )


def first_by_hash(rows: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """The ``n`` rows of smallest key hash, out of about ``total`` distinct keys.

    Hashes beyond the share that surely holds them are left out first, so that no task offers ``n`` rows of its own.
    """
    share = min(1.0, (n + 8 * n**0.5 + 16) / max(total, 1))
    h = F.xxhash64(key)
    return rows.where(h <= min((1 << 63) - 1, int(share * 2**64) - (1 << 63))).orderBy(h, key).limit(n)


def score(docs: DataFrame, labels: DataFrame, fold: int = 2, folds: int = 4, sample: int = SAMPLE, threshold: float = THRESHOLD,
          label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Labels of fold ``fold`` are never used."""

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, texts in arrays.batches(batch.column(1)):
            x = figures(texts)
            offsets = pa.array(np.arange(len(texts) + 1) * x.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(texts)), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["did", "x"]
            )

    known = materialize(map_batches(id_and_text(docs, id_col, text_col), measure, "did long, x array<double>"), "figures")
    train = labelled(labels, label).where((remainder("id", folds) != fold) & (F.col("y") == 1))
    rows = known.join(train, known["did"] == train["id"]).select("did", "x")
    text = known.where(remainder("did", folds) != fold)
    # at most 2 * sample rows of figures come to the driver
    positive = first_by_hash(rows, "did", sample, train.count()).select("x").collect()
    unlabelled = first_by_hash(text, "did", sample, text.count()).select("x").collect() if positive else []
    model = None
    if unlabelled:
        p, u = np.array([r[0] for r in positive]), np.array([r[0] for r in unlabelled])
        model = fit(p, u, estimate_prior(p, u))

    def rate(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)
        s = model.score(x) if model else np.full(len(x), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["did", "score"])

    scored = map_batches(known, rate, "did long, score double").select(real_id().alias("doc_id"), "score")
    return scored.select(
        "doc_id", (remainder("doc_id", folds) == fold).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )
