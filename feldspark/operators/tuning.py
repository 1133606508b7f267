"""Hyperparameter search: sampled trials, parallel runs, best trial."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspark.functions.hashing import uniform
from feldspark.operators.mlp import prepare_training, train_mlp
from feldspark.operators.models import complete_rows, random_forest, solve_normal
from feldspark.session import materialize, remove_path

# The default search space.
LEARNING_RATE = (1e-4, 1e-2)
DROPOUT = (0.1, 0.5)
BATCH_SIZES = (64, 128, 256, 512)
HIDDEN_DIMS = (32, 64, 128, 256)
LAYERS = (2, 3, 4)


def _choice(draw: Column, values: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.floor(draw * len(values)).cast("int") + 1)


def search_space(
    trials: DataFrame, trial: str = "trial", seed: int = 42,
    learning_rate: tuple[float, float] = LEARNING_RATE, dropout: tuple[float, float] = DROPOUT,
    batch_sizes: Sequence[int] = BATCH_SIZES, hidden_dims: Sequence[int] = HIDDEN_DIMS,
    layers: Sequence[int] = LAYERS,
) -> DataFrame:
    """One sampled configuration per trial id; the same id always gets the same one."""

    def draw(name: str) -> Column:
        return uniform(seed, F.lit(name), F.col(trial))

    low, high = float(np.log(learning_rate[0])), float(np.log(learning_rate[1]))
    return trials.select(
        trial,
        F.exp(F.lit(low) + draw("learning_rate") * F.lit(high - low)).alias("learning_rate"),
        (F.lit(dropout[0]) + draw("dropout_rate") * F.lit(dropout[1] - dropout[0])).alias("dropout_rate"),
        _choice(draw("batch_size"), batch_sizes).alias("batch_size"),
        _choice(draw("hidden_dim"), hidden_dims).alias("hidden_dim"),
        _choice(draw("num_layers"), layers).alias("num_layers"),
    )


def ridge_trials(
    df: DataFrame, features: Sequence[str], target: str, alphas: Sequence[float],
    validation_split: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Train and validation loss of ridge regression for each alpha, all from one pass.

    Both losses are functions of the second moments of the two parts, so one aggregate
    serves every trial.
    """
    names = [*features, target]
    rows = complete_rows(df, names)
    held = uniform(seed, *[F.col(n) for n in names]) < F.lit(validation_split)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    parts = {r["_held"]: r for r in rows.withColumn("_held", held).groupBy("_held").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).collect()}
    k = len(features)

    def moment(row) -> tuple[np.ndarray, np.ndarray]:
        c = np.zeros((k + 1, k + 1))
        for i, j in pairs:
            c[i, j] = c[j, i] = row[f"c{i}_{j}"]
        return c, np.array([row[f"m{i}"] for i in range(k + 1)])

    def loss(row, w: np.ndarray, b: float) -> float | None:
        if row is None:
            return None
        c, m = moment(row)
        full = np.append(-w, 1.0)
        return float(full @ c @ full + (m[k] - m[:k] @ w - b) ** 2)

    train = parts.get(False)
    if train is None:
        raise ValueError("no complete training rows")
    c, m = moment(train)
    trials = []
    for i, alpha in enumerate(alphas):
        w = solve_normal(c[:k, :k] + np.eye(k) * (alpha / train["n"]), c[:k, k])
        b = float(m[k] - m[:k] @ w)
        trials.append((i, float(alpha), loss(train, w, b), loss(parts.get(True), w, b)))
    return df.sparkSession.createDataFrame(trials, "trial int, alpha double, train_loss double, val_loss double")


def forest_trials(
    df: DataFrame, features: Sequence[str], target: str, trees: Sequence[int], depths: Sequence[int],
    validation_split: float = 0.2, seed: int = 42, parallelism: int = 2,
) -> DataFrame:
    """Validation error of forests over a grid, several fits at a time.

    Which rows are held out follows from their values, not from where they lie.
    """
    rows_in = complete_rows(df, [*features, target])
    draw = uniform(seed, *[F.col(c) for c in rows_in.columns])
    # rows go to places that follow from their values, as the forests' row samples follow from places
    placed = rows_in.repartition(F.xxhash64(*rows_in.columns)).sortWithinPartitions(*rows_in.columns)
    parts = materialize(placed.withColumn("_held", draw < F.lit(validation_split)), "trials")
    fitted, held = parts.filter("NOT _held").drop("_held"), parts.filter("_held").drop("_held")
    grid = [(n, d) for n in trees for d in depths]

    def run(config: tuple[int, int]) -> float | None:
        model = random_forest(fitted, features, target, *config, seed=seed)
        error = F.col("prediction") - F.col(target)
        return model.transform(held).agg(F.avg(error * error)).first()[0]

    losses = run_trials(grid, run, parallelism)
    rows = [(i, n, d, loss) for i, ((n, d), loss) in enumerate(zip(grid, losses, strict=True))]
    return df.sparkSession.createDataFrame(rows, "trial int, num_trees int, max_depth int, val_loss double")


def run_trials(configs: Sequence, run: Callable, parallelism: int = 2) -> list:
    """Start several trials at a time; each is a sequence of Spark jobs of its own."""
    with ThreadPool(max(1, parallelism)) as pool:
        return pool.map(run, configs)


def mlp_trials(
    df: DataFrame, features: Sequence[str], target: str, configs: Sequence[dict], parallelism: int = 2, **fixed
) -> DataFrame:
    """Train a network per configuration on rows prepared once; one row per trial and epoch."""
    shared = {k: fixed.pop(k) for k in ("validation_split", "block_rows") if k in fixed}
    ready = prepare_training(df, features, target, seed=fixed.get("seed", 42), **shared)

    def run(config: dict) -> list[dict]:
        return train_mlp(df, features, target, **{**fixed, **config}, prepared=ready).history

    rows = [
        (i, h["epoch"], float(h["train_loss"]), h.get("val_loss"))
        for i, history in enumerate(run_trials(configs, run, parallelism)) for h in history
    ]
    remove_path(df.sparkSession, ready.path)
    return df.sparkSession.createDataFrame(rows, "trial int, epoch int, train_loss double, val_loss double")


def network_configs(space: DataFrame) -> list[dict]:
    """Sampled trials (``search_space``) as options of ``train_mlp``, in order of trial; a short list."""
    return [
        {"learning_rate": r["learning_rate"], "batch_size": r["batch_size"], "hidden": (r["hidden_dim"],) * r["num_layers"]}
        for r in space.orderBy("trial").collect()
    ]


def tune_mlp(
    df: DataFrame, features: Sequence[str], target: str, trials: DataFrame, epochs: int = 10, seed: int = 42, **fixed
) -> tuple[DataFrame, DataFrame]:
    """Sample a configuration per trial id, train them all, and return (all epochs, the best trial's last one)."""
    space = search_space(trials, seed=seed)
    history = mlp_trials(df, features, target, network_configs(space), epochs=epochs, seed=seed, **fixed)
    return history, best_trial(last_epochs(history), "val_loss")


def last_epochs(history: DataFrame) -> DataFrame:
    """The last epoch of each trial."""
    values = [c for c in history.columns if c != "trial"]
    return history.groupBy("trial").agg(F.max_by(F.struct(*values), "epoch").alias("r")).select("trial", "r.*")


class Watch:
    """The callbacks of one trial: it lowers the rate on a plateau and says when to stop."""

    def __init__(self, rate: float, patience: int = 10, plateau: int = 5, factor: float = 0.5, min_rate: float = 1e-6, min_delta: float = 1e-4):
        self.rate, self.patience, self.plateau, self.factor, self.min_rate, self.min_delta = rate, patience, plateau, factor, min_rate, min_delta
        self.best, self.waited, self.stalled = float("inf"), 0, 0

    def after(self, loss: float) -> bool:
        """Take the loss of an epoch; whether training stops."""
        if loss < self.best - self.min_delta:
            self.best, self.waited, self.stalled = loss, 0, 0
            return False
        self.waited, self.stalled = self.waited + 1, self.stalled + 1
        if self.stalled >= self.plateau:
            self.rate, self.stalled = max(self.rate * self.factor, self.min_rate), 0
        return self.waited >= self.patience


def tune_sampled(
    space: DataFrame, start: Callable[[dict], object], epoch: Callable[[object, float], tuple[object, float, float | None]],
    epochs: int = 10, parallelism: int = 4, **watch,
) -> DataFrame:
    """Trials of a sampled space, several at a time, each reported per epoch and steered by ``Watch``.

    ``start(config)`` gives a trial's state, ``epoch(state, rate)`` the state after one more pass with its train and
    validation loss; what either does with data is Spark jobs of its own. A worker takes the next trial as soon as one
    is done, so slow trials hold up no other. A trial that fails ends with its error and the rest go on. Returns one row
    per trial and epoch: trial, epoch, rate, train_loss, val_loss, error.
    """
    configs = [r.asDict() for r in space.orderBy("trial").collect()]  # a search has a short list of trials

    def run(config: dict) -> list[tuple]:
        rows: list[tuple] = []
        try:
            state, steering = start(config), Watch(config["learning_rate"], **watch)
            for number_ in range(1, epochs + 1):
                rate = steering.rate
                state, train, held = epoch(state, rate)
                rows.append((config["trial"], number_, rate, float(train), None if held is None else float(held), None))
                if steering.after(train if held is None else held):
                    break
        except Exception as e:  # noqa: BLE001 - the failure is the result
            rows.append((config["trial"], len(rows) + 1, None, None, None, f"{type(e).__name__}: {e}"))
        return rows

    with ThreadPool(max(1, parallelism)) as pool:
        done = [row for rows in pool.imap_unordered(run, configs) for row in rows]
    return space.sparkSession.createDataFrame(
        sorted(done), f"trial {space.schema['trial'].dataType.simpleString()}, epoch int, rate double, train_loss double, val_loss double, error string"
    )


def moment_descent(df: DataFrame, features: Sequence[str], target: str, held: Column):
    """(start, epoch) for ``tune_sampled``: a linear model by full-batch gradient steps on standardized columns.

    One aggregate over the table gives the second moments of the fitted and the held rows; every epoch of every trial
    follows from them, so a search of any length reads the table once.
    """
    names = [*features, target]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    got = {r["_held"]: r for r in complete_rows(df, names, [held.alias("_held")]).groupBy("_held").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).collect()}
    if False not in got:
        raise ValueError("no complete training rows")
    k = len(features)
    center = np.array([got[False][f"m{i}"] for i in range(k + 1)])
    scale = np.array([got[False][f"c{i}_{i}"] ** 0.5 or 1.0 for i in range(k + 1)])

    def second(row) -> np.ndarray:
        """Mean products of (1, features, target), standardized."""
        m = (np.array([row[f"m{i}"] for i in range(k + 1)]) - center) / scale
        out = np.ones((k + 2, k + 2))
        out[0, 1:] = out[1:, 0] = m
        for i, j in pairs:
            out[i + 1, j + 1] = out[j + 1, i + 1] = row[f"c{i}_{j}"] / (scale[i] * scale[j]) + m[i] * m[j]
        return out

    parts = {side: second(row) for side, row in got.items()}

    def loss(side: bool, w: np.ndarray) -> float | None:
        full = np.append(-w, 1.0)
        return float(full @ parts[side] @ full) if side in parts else None

    def start(config: dict) -> np.ndarray:
        return np.zeros(k + 1)

    def epoch(w: np.ndarray, rate: float):
        m = parts[False]
        w = w - rate * 2 * (m[:-1, :-1] @ w - m[:-1, -1])
        return w, loss(False, w), loss(True, w)

    return start, epoch


def best_trial(trials: DataFrame, metric: str, mode: str = "min", tie: str = "trial") -> DataFrame:
    """The row with the least (or greatest) metric; the smallest trial id wins ties."""
    if mode not in ("min", "max"):
        raise ValueError(f"Unknown mode: {mode}")
    value = F.when(~F.isnan(F.col(metric).cast("double")), F.col(metric).cast("double"))
    key = F.struct((value if mode == "min" else -value).alias("m"), F.col(tie).alias("t"))
    packed = trials.filter(value.isNotNull()).agg(F.min_by(F.struct(*trials.columns), key).alias("best"))
    return packed.filter(F.col("best").isNotNull()).select("best.*")
