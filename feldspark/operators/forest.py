"""Forests of many rows from one pass: sums per tree and cell of binned features, split on the driver.

A tree looks at rows only through their bins, and at targets only through counts, sums and sums of squares. So what
a forest of any depth needs of a table are these three numbers per tree and cell, where a cell is one combination of
bins. They are added up while the rows stream by; no row is kept with its draws, whatever the number of trees.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame

# The functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 1 << 20  # cells times trees that a task may add up, 24 bytes each
SPLIT_ROWS = 10_000  # rows, or the square of the bins if more, that place the splits, as in Spark's own forests
SUMS = "cell long, task long, sums array<double>"


def find_splits(rows: DataFrame, features: Sequence[str], bins: int, seed: int, n: int) -> list[np.ndarray]:
    """At most ``bins - 1`` thresholds a feature: between all values if they are few, else at about even counts."""
    share = max(bins * bins, SPLIT_ROWS) / max(n, 1)
    taken = rows.select(*features)
    found = np.array((taken if share >= 1 else taken.sample(False, share, seed)).collect(), dtype=np.float64)
    return [_thresholds(*np.unique(found.reshape(-1, len(features))[:, i], return_counts=True), bins - 1) for i in range(len(features))]


def _thresholds(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) <= most:
        return middles
    step = counts.sum() / (most + 1)
    target, upto, out = step, np.cumsum(counts), []
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middles[i - 1])
            target += step
    return np.array(out)


def cells(splits: Sequence[np.ndarray]) -> int:
    return math.prod(len(s) + 1 for s in splits)


def _draws() -> Callable[[np.random.Generator, tuple[int, int]], np.ndarray]:
    """Poisson draws of mean one: 32 random bits against the distribution, most settled by the first 16."""
    mass = [math.exp(-1) / math.factorial(k) for k in range(14)]
    ends = np.floor(np.cumsum(mass) * 2.0**32).astype(np.uint64)
    low = np.searchsorted(ends, np.arange(1 << 16, dtype=np.uint64) << np.uint64(16), side="right").astype(np.uint8)
    high = np.searchsorted(ends, (np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)) + np.uint64(0xFFFF), side="right").astype(np.uint8)
    open_ = low != high

    def draw(rng: np.random.Generator, shape: tuple[int, int]) -> np.ndarray:
        bits = rng.integers(0, 1 << 32, size=shape[0] * shape[1], dtype=np.uint32)
        first = (bits >> np.uint32(16)).astype(np.uint16)
        out = low[first]
        rest = np.flatnonzero(open_[first])
        out[rest] = np.searchsorted(ends, bits[rest].astype(np.uint64), side="right")
        return out.reshape(shape).astype(np.float64)

    return draw


def _summed(splits: Sequence[np.ndarray], trees: int, seed: int, all_rows: bool):
    """Per cell of a task the count, sum and sum of squares of the targets of each tree's rows, each drawn as often as it falls."""
    size = cells(splits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, draw = TaskContext.get().partitionId(), _draws()
        rng = np.random.default_rng([seed & 0xFFFFFFFF, task])
        total = np.zeros((size, 3, trees))
        for batch in batches:
            if not batch.num_rows:
                continue
            *xs, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            code = np.zeros(len(y), dtype=np.int64)
            for x, s in zip(xs, splits):
                code = code * (len(s) + 1) + np.searchsorted(s, x, side="left")
            order = np.argsort(code, kind="stable")
            code, y = code[order], y[order]
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            part = np.ones((len(y), trees)) if all_rows else draw(rng, (len(y), trees))
            for k in range(3):
                if k:
                    part *= y[:, None]
                total[code[starts], k] += np.add.reduceat(part, starts, axis=0)
        seen = np.flatnonzero(total[:, 0].any(axis=1))
        for at in range(0, len(seen), 256):
            some = seen[at:at + 256]
            sums = pa.array(list(total[some].reshape(len(some), -1)), type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), task, dtype=np.int64)), sums], ["cell", "task", "sums"])

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("task")
    total = np.zeros(len(rows["sums"].iloc[0]))
    for v in rows["sums"]:
        total += v
    return pd.DataFrame({"cell": [rows["cell"].iloc[0]], "task": [rows["task"].iloc[0]], "sums": [total]})


def grow_forest(
    rows: DataFrame, features: Sequence[str], target: str, splits: Sequence[np.ndarray], trees: int, depth: int, seed: int,
    every_feature: bool, all_rows: bool,
) -> RandomForestRegressionModel:
    """A forest by the rules of Spark's own (variance, a third of the features a node, no split without gain)."""
    taken = rows.select(*features, target).mapInArrow(_summed(splits, trees, seed, all_rows), SUMS)
    found = taken.groupBy("cell").applyInPandas(_added, SUMS).orderBy("cell").collect()  # one row a cell
    code = np.array([r["cell"] for r in found], dtype=np.int64)
    sums = np.array([r["sums"] for r in found]).reshape(len(found), 3, trees)
    binned = np.zeros((len(code), len(features)), dtype=np.int64)
    for i in range(len(features) - 1, -1, -1):
        code, binned[:, i] = np.divmod(code, len(splits[i]) + 1)
    few = len(features) if every_feature or trees == 1 else math.ceil(len(features) / 3)
    context = rows.sparkSession.sparkContext
    jvm, gateway = context._jvm, context._gateway
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    built = gateway.new_array(kind, trees)
    for t in range(trees):
        rng = np.random.default_rng([seed & 0xFFFFFFFF, t])
        root = _node(binned, sums[:, :, t], splits, depth, few, rng, 0)
        built[t] = kind(f"dtr_{uuid.uuid4().hex[:12]}", _spark_node(jvm, gateway, root), len(features))
    forest = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(f"rfr_{uuid.uuid4().hex[:12]}", built, len(features))
    return RandomForestRegressionModel(forest)


def _node(binned: np.ndarray, sums: np.ndarray, splits, depth: int, few: int, rng, level: int) -> dict:
    """The tree below a node that holds these cells."""
    n, s, q = total = sums.sum(axis=0)
    impurity = (q - s * s / n) / n
    node = {"stats": total, "prediction": s / n, "impurity": impurity, "gain": 0.0}
    if level == depth or level and abs(impurity) < sys.float_info.epsilon:
        return node
    for f in sorted(rng.choice(len(splits), few, replace=False)):
        if not len(splits[f]):
            continue
        left = np.stack([np.bincount(binned[:, f], weights=sums[:, k], minlength=len(splits[f]) + 1) for k in range(3)]).cumsum(axis=1)[:, :-1]
        right = total[:, None] - left
        with np.errstate(all="ignore"):
            gains = impurity - sum(x[0] / n * ((x[2] - x[1] ** 2 / x[0]) / x[0]) for x in (left, right))
        gains = np.where((left[0] >= 1) & (right[0] >= 1), gains, -np.inf)
        best = int(np.argmax(gains))
        if gains[best] > node["gain"]:
            node |= {"gain": gains[best], "feature": int(f), "bin": best, "threshold": splits[f][best]}
    if node["gain"] > 0:
        under = binned[:, node["feature"]] <= node["bin"]
        node["below"] = [_node(binned[m], sums[m], splits, depth, few, rng, level + 1) for m in (under, ~under)]
    return node


def _spark_node(jvm, gateway, node: dict):
    stats = gateway.new_array(gateway.jvm.double, 3)
    for i, v in enumerate(node["stats"]):
        stats[i] = float(v)
    held = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(node["stats"][0]))
    own = float(node["prediction"]), float(node["impurity"])
    if "below" not in node:
        return jvm.org.apache.spark.ml.tree.LeafNode(*own, held)
    split = jvm.org.apache.spark.ml.tree.ContinuousSplit(node["feature"], float(node["threshold"]))
    return jvm.org.apache.spark.ml.tree.InternalNode(*own, float(node["gain"]), *(_spark_node(jvm, gateway, x) for x in node["below"]), split, held)
