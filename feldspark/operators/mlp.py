"""A dense network for regression, trained data-parallel with one Spark job per round.

Rows are written once in blocks that follow from their values, a block packed into one row of a
table, or into several pieces if it is large. In a round each block is passed by mini-batch Adam,
starting from the shared weights and moments; the new ones are the row-weighted means over the blocks.
A task adds its blocks up and returns one array, and arrays of many tasks are added in a tree, so a
round moves a fixed number of parameters per task, whatever the size of the table.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from feldspark.functions.hashing import driver_normal
from feldspark.operators.models import complete_rows
from feldspark.operators.ordering import group_sizes
from feldspark.session import remove_path, scratch_path

# The batch functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 65_536  # rows of a block, or of a piece of a larger one; either is one packed row
PIECES = 16  # that one task cuts, about, at most
FILES = 10_000  # of a prepared table, at most about so many
FAN_IN = 64  # arrays that are added up by one task of the tree

_ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda z: (z > 0).astype(z.dtype)),
    "tanh": (np.tanh, lambda z: 1.0 - np.tanh(z) ** 2),
}


def _shapes(sizes: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(sizes[:-1], sizes[1:], strict=True))


def _unpack(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for n, m in _shapes(sizes):
        layers.append((flat[at:at + n * m].reshape(n, m), flat[at + n * m:at + n * m + m]))
        at += n * m + m
    return layers


def _forward(flat, sizes, x, activation):
    act = _ACTIVATIONS[activation][0]
    layers = _unpack(flat, sizes)
    inputs, sums = [x], []
    for i, (w, b) in enumerate(layers):
        z = inputs[-1] @ w + b
        sums.append(z)
        inputs.append(z if i == len(layers) - 1 else act(z))
    return inputs, sums


def _gradient(flat, sizes, x, y, activation) -> tuple[np.ndarray, float]:
    """Gradient of the mean squared error over the batch, and that error."""
    slope = _ACTIVATIONS[activation][1]
    inputs, sums = _forward(flat, sizes, x, activation)
    error = inputs[-1][:, 0] - y
    delta = y.dtype.type(2.0 / len(y)) * error[:, None]
    parts: list[np.ndarray] = []
    layers = _unpack(flat, sizes)
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.concatenate([(inputs[i].T @ delta).ravel(), delta.sum(axis=0)]))
        if i:
            delta = (delta @ layers[i][0].T) * slope(sums[i - 1])
    return np.concatenate(parts[::-1]), float(np.mean(error**2))


@dataclass
class MLPModel:
    """Layer sizes, weights and the scaling of inputs and target."""

    features: list[str]
    sizes: list[int]
    weights: list[float]
    centers: list[float]
    scales: list[float]
    target_center: float = 0.0
    target_scale: float = 1.0
    activation: str = "relu"
    hyperparameters: dict = field(default_factory=dict)
    history: list[dict] = field(default_factory=list)
    optimizer: dict | None = None  # moments, steps, rate and counters, to go on from

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Score in Arrow batches; rows that miss a feature get NULL."""
        flat, sizes, activation = np.array(self.weights), self.sizes, self.activation
        center, scale = self.target_center, self.target_scale

        @pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, sizes[0]))
            return pd.Series(_forward(flat, sizes, rows, activation)[0][-1][:, 0] * scale + center)

        scaled = [
            (number_or_zero(df, f) - F.lit(c)) / F.lit(s)
            for f, c, s in zip(self.features, self.centers, self.scales, strict=True)
        ]
        whole = ~F.exists(F.array(*[F.col(f"`{f}`").cast("double") for f in self.features]),
                          lambda v: v.isNull() | F.isnan(v))
        return df.withColumn("_x", F.array(*scaled)).withColumn(output, F.when(whole, predict("_x"))).drop("_x")


def number_or_zero(df: DataFrame, name: str):
    c = F.col(f"`{name}`").cast("double")
    return F.coalesce(F.when(~F.isnan(c), c), F.lit(0.0))


def initial_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Normal weights of variance 1/(3·inputs) per layer, zero biases."""
    parts = []
    for layer, (n, m) in enumerate(_shapes(sizes)):
        draws = [driver_normal(seed, "weight", layer, i) for i in range(n * m)]
        parts += [np.array(draws) * np.sqrt(1.0 / (3.0 * n)), np.zeros(m)]
    return np.concatenate(parts)


PACKED = "block long, piece long, fitted binary, held binary"


@dataclass
class Prepared:
    """Standardized rows in written blocks, shared by all networks trained on them."""

    path: str
    features: list[str]
    centers: list[float]
    scales: list[float]
    blocks: int = 0  # how many there are, if some are in several pieces
    largest: int = 0  # rows of the largest one then


def prepare_training(
    df: DataFrame, features: Sequence[str], target: str, validation_split: float = 0.2, seed: int = 42,
    block_rows: int = BLOCK_ROWS, block: str | None = None, held: str | None = None,
) -> Prepared:
    """Standardize and write the complete rows in blocks of about ``block_rows``.

    Block, order within it and what is held out follow from the values of a row, so they do
    not depend on how the table or the cluster is partitioned. A whole-number column ``block`` may name the
    blocks, and a boolean column ``held`` the rows held out. Named blocks of more than ``block_rows`` are cut into
    pieces by many tasks, so that none holds a block.
    """
    names = [*features, target]
    draw = F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(1 << 20)) / F.lit(float(1 << 20))
    given = [F.col(f"`{c}`").alias(n) for c, n in ((block, "_block"), (held, "_held")) if c]
    marked = complete_rows(df, names, given)
    if not held:
        marked = marked.withColumn("_held", draw < F.lit(validation_split))
    fitted = F.col("_held") == F.lit(False)
    row = marked.agg(
        F.count_if(fitted).alias("n"), F.count(F.lit(1)).alias("total"),
        *[F.avg(F.when(fitted, F.col(n))).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.stddev_pop(F.when(fitted, F.col(n))).alias(f"s{i}") for i, n in enumerate(names)],
    ).first()
    if not row["n"]:
        raise ValueError("no complete training rows")
    centers = [row[f"m{i}"] for i in range(len(names))]
    scales = [row[f"s{i}"] or 1.0 for i in range(len(names))]
    scaled = [((F.col(n) - F.lit(c)) / F.lit(s)).alias(f"v{i}")
              for i, (n, c, s) in enumerate(zip(names, centers, scales, strict=True))]
    blocks = max(1, -(-row["total"] // block_rows)) if block is None else None
    values = [f"v{i}" for i in range(len(names))]
    if block is None:
        # equal rows are counted once and dealt to different blocks, so that no block is filled by one value
        counted = marked.select("_held", *scaled, F.xxhash64(F.lit(seed + 1), *names).alias("_place"), F.xxhash64(F.lit(seed + 2), *names).alias("_order"))
        counted = counted.groupBy("_held", *values, "_place", "_order").agg(F.count(F.lit(1)).alias("_n"))
        counted = counted.withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_n"), F.lit(blocks).cast("long")) - 1)))
        packed = counted.select(
            "_held", *values, "_order", F.pmod(F.col("_place") + F.col("_t"), F.lit(blocks)).cast("long").alias("_block"),
            (F.floor((F.col("_n") - F.col("_t") - 1) / blocks) + 1).cast("long").alias("_n"),
        )
    else:
        packed = marked.select("_held", *scaled, F.xxhash64(F.lit(seed + 2), *names).alias("_order"), F.col("_block"), F.lit(1).cast("long").alias("_n"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_order", *values])
        times, held = rows["_n"].to_numpy(), rows["_held"].to_numpy(dtype=bool)
        matrix = rows[values].to_numpy(np.float64)
        out = [np.repeat(matrix[m], times[m], axis=0).tobytes() for m in (~held, held)]
        return pd.DataFrame({"block": [int(key[0])], "piece": [0], "fitted": [out[0]], "held": [out[1]]})

    path = scratch_path(df.sparkSession, "training")
    largest = group_sizes(packed, ["_block"])[0] if blocks is None else 0
    if largest <= block_rows:
        per_file = max(1, (blocks or 1) // FILES)
        packed.groupBy("_block").applyInPandas(pack, PACKED).write.option("maxRecordsPerFile", per_file).parquet(path)
        return Prepared(path, list(features), centers, scales)

    known = F.coalesce(F.col("_block").cast("long"), F.raise_error(F.lit("a row without a block")).cast("long"))
    key = ["_block", "_order", *values]
    pieces, parts = -(-row["total"] // block_rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = packed.withColumn("_block", known).repartitionByRange(max(-(-pieces // PIECES), min(pieces, parts)), *key)
    # the first place of a piece is its number: pieces of a block ascend as its rows do
    placed = ranged.sortWithinPartitions(*key).select(
        "_block", F.monotonically_increasing_id().alias("_at"), F.coalesce("_held", F.lit(False)).alias("_held"), *values
    )
    per_file = max(1, pieces // FILES)
    placed.mapInPandas(_cut(values, block_rows), PACKED).write.option("maxRecordsPerFile", per_file).parquet(path)
    blocks = df.sparkSession.read.schema(PACKED).parquet(path).select("block").distinct().count()
    return Prepared(path, list(features), centers, scales, blocks, largest)


def _cut(values: Sequence[str], piece_rows: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows in order of their blocks as packed pieces of at most ``piece_rows``; holds one piece at a time."""

    def piece(block: int, at: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        matrix, held = (np.concatenate(x) for x in zip(*parts))
        out = [np.ascontiguousarray(matrix[m]).tobytes() for m in (~held, held)]
        return pd.DataFrame({"block": [block], "piece": [at], "fitted": [out[0]], "held": [out[1]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, at, size, parts = None, None, 0, []
        for frame in batches:
            names, places = frame["_block"].to_numpy(), frame["_at"].to_numpy()
            matrix, held = frame[values].to_numpy(np.float64), frame["_held"].to_numpy(dtype=bool)
            start = 0
            while start < len(names):
                if size and (names[start] != block or size == piece_rows):
                    yield piece(block, at, parts)
                    size, parts = 0, []
                if not size:
                    block, at = int(names[start]), int(places[start])
                end = min(int(np.searchsorted(names, block, side="right")), start + piece_rows - size)
                parts.append((matrix[start:end], held[start:end]))
                size, start = size + end - start, end
        if size:
            yield piece(block, at, parts)

    return run


def train_mlp(
    df: DataFrame, features: Sequence[str], target: str, hidden: Sequence[int] = (64, 32),
    epochs: int = 10, batch_size: int = 1024, learning_rate: float = 1e-3, weight_decay: float = 0.0,
    validation_split: float = 0.2, seed: int = 42, block_rows: int = BLOCK_ROWS, activation: str = "relu",
    prepared: Prepared | None = None, patience: int | None = None, min_delta: float = 1e-4,
    plateau: dict | None = None, on_epoch: Callable[[int, MLPModel], None] | None = None,
    resume: MLPModel | None = None, double: bool = False,
) -> MLPModel:
    """Train and return the model; ``history`` has train and validation loss per epoch.

    Losses are on the standardized target, so 1.0 is the loss of predicting the mean.
    ``patience`` epochs without a gain of ``min_delta`` stop the training; ``plateau``
    (factor, patience, min_lr) lowers the rate; ``on_epoch`` gets the model after each epoch.
    ``resume`` goes on from a model (as returned, stored or given to ``on_epoch``) with its moments, steps, rate
    and counters, so that ``epochs`` in two runs equal those of one. ``double`` computes in double precision.
    """
    spark = df.sparkSession
    ready = prepared or prepare_training(df, features, target, validation_split, seed, block_rows)
    table = spark.read.schema(PACKED).parquet(ready.path)
    sizes = [len(features), *hidden, 1]
    flat = initial_weights(sizes, seed)
    first, second, steps = np.zeros_like(flat), np.zeros_like(flat), 0
    options = {
        "hidden": list(hidden), "epochs": epochs, "batch_size": batch_size,
        "learning_rate": learning_rate, "weight_decay": weight_decay, "seed": seed,
    }
    history: list[dict] = []
    watched = patience is not None or plateau is not None
    best, waited, stalled, rate = np.inf, 0, 0, learning_rate
    if resume is not None:
        if resume.sizes != sizes or resume.optimizer is None:
            raise ValueError("cannot resume from a model of other layers or without the state of its training")
        state = resume.optimizer
        flat, first, second = (np.array(v) for v in (resume.weights, state["first"], state["second"]))
        steps, rate, waited, stalled = state["steps"], state["rate"], state["waited"], state["stalled"]
        best = np.inf if state["best"] is None else state["best"]
        history = [dict(h) for h in resume.history]
    tasks = table.rdd.getNumPartitions()

    def model() -> MLPModel:
        state = {
            "first": first.tolist(), "second": second.tolist(), "steps": int(steps), "rate": float(rate),
            "best": None if np.isinf(best) else float(best), "waited": waited, "stalled": stalled,
        }
        return MLPModel(
            list(features), sizes, flat.tolist(), ready.centers[:-1], ready.scales[:-1], ready.centers[-1], ready.scales[-1],
            activation, options, [dict(h) for h in history], state,
        )

    done = patience is not None and waited >= patience
    for epoch in range(len(history) + 1, epochs + 1) if not done else ():
        shared = spark.sparkContext.broadcast((flat, first, second, steps))
        kind = np.float64 if double else np.float32
        work = _block_round(shared, sizes, activation, batch_size, rate, weight_decay, kind)
        # the held rows are scored with the weights the round starts from: the last epoch's
        if not ready.blocks:
            sums = added_up(table.mapInPandas(work, SUMS), tasks)
        elif batch_size >= ready.largest:
            # one step a block: its gradient is a sum over pieces, wherever they lie
            grads = table.mapInPandas(_piece_gradients(shared, sizes, activation, kind), f"block long, {SUMS}")
            summed = grads.groupBy("block").applyInPandas(_add, SUMS)
            sums = added_up(summed.mapInPandas(_one_step(shared, rate, weight_decay, kind), SUMS), ready.blocks)
        else:
            sums = added_up(_by_block(table, ready.blocks).mapInPandas(work, SUMS), ready.blocks)
        shared.unpersist()
        flat, first, second = (sums["state"].reshape(3, -1) / sums["rows"]) if sums["rows"] else (flat, first, second)
        steps = max(steps, int(sums["steps"]))
        if history and not watched:
            history[-1]["val_loss"] = sums["held_error"] / sums["held"] if sums["held"] else None
        history.append({"epoch": epoch, "train_loss": sums["error"] / sums["rows"] if sums["rows"] else None, "val_loss": None})
        if watched or epoch == epochs:
            history[-1]["val_loss"] = _loss(table.select("held"), flat, sizes, activation)
        if watched:
            seen = history[-1]["val_loss"] if history[-1]["val_loss"] is not None else history[-1]["train_loss"]
            gained = seen < best - min_delta
            best, waited, stalled = (seen, 0, 0) if gained else (best, waited + 1, stalled + 1)
            if plateau is not None and stalled >= plateau.get("patience", 5):
                rate, stalled = max(rate * plateau.get("factor", 0.5), plateau.get("min_lr", 1e-6)), 0
        if on_epoch:
            on_epoch(epoch, model())
        if patience is not None and waited >= patience:
            break
    if prepared is None:
        remove_path(spark, ready.path)
    return model()


SUMS = "place long, state array<double>, steps long, rows long, error double, held long, held_error double"


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for many: states and counts added up in order of place."""
    rows = rows.sort_values("place")
    state = np.zeros(len(rows["state"].iloc[0]))
    for v in rows["state"]:
        state += v
    return pd.DataFrame({
        "place": [rows["place"].iloc[0]], "state": [state], "steps": [rows["steps"].max()],
        **{c: [rows[c].sum()] for c in ("rows", "error", "held", "held_error")},
    })


def added_up(parts: DataFrame, tasks: int) -> dict:
    """The sum of one row a task; beyond ``FAN_IN`` tasks rows are first added in a tree of tasks."""
    groups = tasks
    while groups > FAN_IN:
        groups = -(-groups // FAN_IN)
        parts = parts.groupBy(F.pmod(F.xxhash64("place"), F.lit(groups)).alias("_g")).applyInPandas(_add, SUMS)
    held = parts.collect()  # at most about FAN_IN rows of three numbers a parameter
    if not held:
        raise ValueError("no complete training rows")
    row = _add(pd.DataFrame([r.asDict() for r in held])).iloc[0]
    return {**row.to_dict(), "state": np.asarray(row["state"])}


def checkpointer(registry, name: str, every: int = 5, keep: int = 3) -> Callable[[int, MLPModel], None]:
    """An ``on_epoch`` that registers the model of every ``every``-th epoch and keeps the newest ``keep``."""
    held: list[str] = []

    def store(epoch: int, model: MLPModel) -> None:
        if epoch % every and epoch != model.hyperparameters["epochs"]:
            return
        held.append(f"epoch-{epoch:05d}")
        registry.save(name, held[-1], model, metrics={"epoch": float(epoch)})
        while len(held) > keep:
            registry.delete(name, held.pop(0))

    return store


def _adam(state: tuple, grad: np.ndarray, learning_rate: float, weight_decay: float) -> tuple:
    """Weights, moments and steps after one step."""
    flat, first, second, steps = state
    grad = grad + weight_decay * flat
    steps += 1
    first = 0.9 * first + 0.1 * grad
    second = 0.999 * second + 0.001 * grad**2
    flat = flat - learning_rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.999**steps)) + 1e-8)
    return flat, first, second, steps


def _begin(shared, kind) -> tuple:
    flat, first, second, steps = shared.value
    return flat.astype(kind), first.astype(kind), second.astype(kind), steps


class _Pass:
    """Mini-batch Adam over the rows of one block, piece by piece; a batch may reach over pieces."""

    def __init__(self, state: tuple, sizes, activation, batch_size: int, learning_rate: float, weight_decay: float):
        self.state, self.options = state, (sizes, activation)
        self.batch_size, self.rates = batch_size, (learning_rate, weight_decay)
        self.grad, self.seen, self.rows, self.error = None, 0, 0, 0.0  # of the batch: mean gradient, rows

    def take(self, values: np.ndarray) -> None:
        at = 0
        while at < len(values):
            part = values[at:at + self.batch_size - self.seen]
            grad, loss = _gradient(self.state[0], self.options[0], part[:, :-1], part[:, -1], self.options[1])
            n = self.seen + len(part)
            self.grad = grad if not self.seen else (self.grad * (self.seen / n) + grad * (len(part) / n)).astype(grad.dtype)
            self.seen, at = n, at + len(part)
            self.rows, self.error = self.rows + len(part), self.error + loss * len(part)
            if self.seen == self.batch_size:
                self.step()

    def step(self) -> None:
        if self.seen:
            self.state, self.seen = _adam(self.state, self.grad, *self.rates), 0

    def end(self) -> tuple[np.ndarray, int]:
        self.step()
        return np.concatenate(self.state[:3]).astype(np.float64), self.state[3]


def _by_block(table: DataFrame, blocks: int) -> DataFrame:
    """The pieces of a block in one task, in order."""
    tasks = min(blocks, max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), table.rdd.getNumPartitions()))
    return table.repartition(tasks, "block").sortWithinPartitions("block", "piece")


def _matrix(packed: bytes, width: int, kind) -> np.ndarray:
    return np.frombuffer(packed).reshape(-1, width).astype(kind)


def _block_round(shared, sizes, activation, batch_size, learning_rate, weight_decay, kind):
    """A pass over each block from the shared state; the weighted sum of the results of a task, one row."""
    width = sizes[0] + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = shared.value[0].astype(kind)
        place, total, most, rows, error, held, held_error = None, np.zeros(3 * len(start)), 0, 0, 0.0, 0, 0.0
        now, going = None, None

        def close() -> None:
            nonlocal total, most, rows, error
            if going is not None and going.rows:
                state, steps = going.end()
                total += state * going.rows
                most, rows, error = max(most, steps), rows + going.rows, error + going.error

        for frame in batches:
            for block, fitted, kept in zip(frame["block"], frame["fitted"], frame["held"]):
                place = block if place is None else min(place, block)
                apart = _matrix(kept, width, kind)
                if len(apart):
                    held += len(apart)
                    held_error += _squared_error(start, sizes, apart, activation)
                if going is None or block != now:
                    close()
                    now, going = block, _Pass(_begin(shared, kind), sizes, activation, batch_size, learning_rate, weight_decay)
                going.take(_matrix(fitted, width, kind))
        close()
        if place is not None:
            yield pd.DataFrame({"place": [place], "state": [total], "steps": [most], "rows": [rows], "error": [error],
                                "held": [held], "held_error": [held_error]})

    return run


def _piece_gradients(shared, sizes, activation, kind):
    """Per block of a task the sum of its rows' gradients at the shared weights."""
    width = sizes[0] + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, found = shared.value[0].astype(kind), {}
        for frame in batches:
            for block, piece, fitted, kept in zip(frame["block"], frame["piece"], frame["fitted"], frame["held"]):
                row = found.setdefault(block, {"place": piece, "state": np.zeros(len(start)), "steps": 0, "rows": 0,
                                               "error": 0.0, "held": 0, "held_error": 0.0})
                row["place"] = min(row["place"], piece)
                values, apart = _matrix(fitted, width, kind), _matrix(kept, width, kind)
                if len(apart):
                    row["held"] += len(apart)
                    row["held_error"] += _squared_error(start, sizes, apart, activation)
                if len(values):
                    grad, loss = _gradient(start, sizes, values[:, :-1], values[:, -1], activation)
                    row["state"] += grad.astype(np.float64) * len(values)
                    row["rows"] += len(values)
                    row["error"] += loss * len(values)
        if found:
            yield pd.DataFrame([{"block": block, **row} for block, row in found.items()])

    return run


def _one_step(shared, learning_rate, weight_decay, kind):
    """From the gradient sums of blocks their states after one step; the weighted sum of a task, one row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for frame in batches:
            for r in frame.to_dict("records"):
                if r["rows"]:
                    grad = (np.asarray(r["state"]) / r["rows"]).astype(kind)
                    *state, r["steps"] = _adam(_begin(shared, kind), grad, learning_rate, weight_decay)
                    r["state"] = np.concatenate(state).astype(np.float64) * r["rows"]
                else:
                    r["state"] = np.zeros(3 * len(shared.value[0]))
                out.append(r)
        if out:
            yield _add(pd.DataFrame(out))

    return run


def _squared_error(flat: np.ndarray, sizes: Sequence[int], values: np.ndarray, activation: str) -> float:
    out = _forward(flat, sizes, values[:, :-1], activation)[0][-1][:, 0]
    return float(np.sum((out - values[:, -1]) ** 2))


def _loss(held: DataFrame, flat: np.ndarray, sizes: Sequence[int], activation: str) -> float | None:
    width = sizes[0] + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for kept in frame["held"]:
                values = np.frombuffer(kept).reshape(-1, width)
                if len(values):
                    yield pd.DataFrame({"e": [_squared_error(flat, sizes, values, activation)], "n": [len(values)]})

    return held.mapInPandas(run, "e double, n long").agg(F.try_divide(F.sum("e"), F.sum("n"))).first()[0]


def history_frame(model: MLPModel, df: DataFrame) -> DataFrame:
    """The training history as rows."""
    rows = [(h["epoch"], float(h["train_loss"]), h.get("val_loss")) for h in model.history]
    return df.sparkSession.createDataFrame(rows, "epoch int, train_loss double, val_loss double")
