"""Run analysis: comparison, flattening, early stopping, learning-rate plateaus, best checkpoints."""

from __future__ import annotations

import sys
import traceback
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.functions.missing import number
from feldspark.operators.ordering import group_sizes, in_blocks, join_lookup, rank_within
from feldspark.session import materialize

# The fold functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 100_000
SPELLED_OUT = 32  # rates in one expression


def compare_runs(metrics: DataFrame, run: str, metric: str, value: str, names: Sequence[str]) -> DataFrame:
    """One row per run with its metrics side by side, and ``is_best`` for the smallest ``val_loss``.

    A missing ``val_loss`` counts as infinite; the first run in order wins ties.
    """
    wide = metrics.groupBy(run).pivot(metric, list(names)).agg(F.max(number(metrics, value)))
    loss = F.col("val_loss") if "val_loss" in names else F.lit(None).cast("double")
    wide = materialize(wide, "runs")
    ranked = F.coalesce(loss, F.lit(float("inf")))
    best = wide.filter(ranked < F.lit(float("inf"))).agg(F.min_by(run, F.struct(ranked, F.col(run)))).first()[0]
    return wide.withColumn("is_best", F.col(run).eqNullSafe(F.lit(best)) & F.col(run).isNotNull())


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested struct columns as columns with dotted names."""

    def leaves(kind: T.DataType, name: str, c: Column) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in leaves(f.dataType, f"{name}.{f.name}", c[f.name])]
        return [c.alias(name)]

    return df.select(*[x for f in df.schema.fields for x in leaves(f.dataType, f.name, F.col(f"`{f.name}`"))])


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def _depth(text: Column) -> Column:
    """How deep the braces of a JSON text nest, strings left out."""
    bare = F.regexp_replace(text, r'"(\\.|[^"\\])*"', "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def follow(s: Column, brace: Column) -> Column:
        now = s["now"] + F.when(brace == "{", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.aggregate(F.regexp_extract_all(bare, F.lit("([{}])")), start, follow, lambda s: s["most"])


def flatten_json(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Each leaf of a JSON object as (keep..., key, value) with an ``a.b.c`` key.

    Lists stay JSON text. Text that is no JSON object gives one row with a NULL key.
    The number of levels is measured first, in one pass over the texts that are objects.
    """
    objects = df.filter(_is_object(F.try_parse_json(F.col(text))))
    levels = objects.agg(F.max(_depth(F.col(text)))).first()[0] or 0
    parsed = df.filter(F.col(text).isNotNull()).select(*keep, F.col(text).alias("_text"), F.try_parse_json(text).alias("_v"))

    def members(value: Column) -> Column:
        return F.map_entries(F.when(_is_object(value), value.cast("map<string,variant>")))

    whole = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value")))
    flat = parsed.select(*keep, "_text", F.inline(F.coalesce(members(F.col("_v")), whole)))
    for _ in range(levels - 1):
        one = F.array(F.struct(F.col("key"), F.col("value")))
        deeper = F.transform(members(F.col("value")), lambda e: F.struct(
            F.concat_ws(".", F.col("key"), e["key"]).alias("key"), e["value"].alias("value")))
        flat = flat.select(*keep, "_text", F.inline(F.coalesce(deeper, one)))
    value = F.when(F.col("key").isNull(), F.col("_text")).otherwise(F.col("value").cast("string"))
    return flat.select(*keep, "key", value.alias("value"))


# ------------------------------------------------------------- ordered folds


def _packed(rows: DataFrame, run: str, epoch: str, loss: str) -> DataFrame:
    """Per run its rows (position, epoch, loss) in order; callers bound the rows per run."""
    row = F.struct(F.col(epoch).alias("epoch"), F.col(loss).alias("loss"))
    if "position" in rows.columns:
        return rows.groupBy(run).agg(
            F.array_sort(F.collect_list(F.struct(F.col("position"), row["epoch"].alias("epoch"), row["loss"].alias("loss")))).alias("_rows")
        )
    listed = rows.groupBy(run).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return listed.withColumn("_rows", F.transform(
        "_rows", lambda r, i: F.struct((i + 1).cast("long").alias("position"), r["epoch"].alias("epoch"), r["loss"].alias("loss"))
    ))


def _slim(df: DataFrame, run: str, epoch: str, loss: str) -> DataFrame:
    return df.select(run, epoch, number(df, loss).alias(loss)).filter(F.col(run).isNotNull())


def _placed(slim: DataFrame, run: str, epoch: str, loss: str, block_rows: int, sizes: tuple[int, int]) -> DataFrame:
    # by epoch, then loss, as when a run is folded in one task
    placed = in_blocks(rank_within(slim, [run], [epoch, loss], sizes=sizes), "position", block_rows)
    # Several jobs follow; a written table keeps them on the same positions. Files in order of the runs (as the window
    # leaves them, so that Spark sorts only after the path by ranges) need no further shuffle to be summed up.
    return materialize(placed.drop("_own").sortWithinPartitions(run, epoch), "positions")


def _zone(patience: int, limit: int) -> int:
    """How many positions of a block may hold its first improvement that matters; as many outcomes a summary may have, so no block is shorter."""
    return patience * (limit + 1)


def _block_outcomes(position: np.ndarray, loss: np.ndarray, patience: int, min_delta: float, zone: int, limit: int) -> list[dict]:
    """What follows in one block from each loss of its first ``zone`` positions that may be an improvement.

    Whatever the best loss before the block, an improvement is lower than everything before it in the block, so only
    prefix minima count, and the next improvement after one is found by binary search among them. Each is followed
    once, from the last one back. A plateau comes ``patience`` positions after the last improvement or plateau.
    At the start of a run nothing is before, so its first loss is the only one to follow.
    """
    loss = np.where(np.isnan(loss), np.inf, loss)
    record = np.flatnonzero(loss < np.concatenate([[np.inf], np.minimum.accumulate(loss)[:-1]]))
    x, at, end = loss[record], position[record], int(position[-1])
    after = np.searchsorted(-x, -(x - min_delta), side="right")  # the first record below x - min_delta
    known: dict[int, tuple] = {}
    near = int(np.searchsorted(at, position[0] + zone))
    near = min(near, 1) if position[0] == 1 else near
    for start in range(near - 1, -1, -1):
        chain = [start]
        while chain[-1] not in known and after[chain[-1]] < len(x):
            chain.append(int(after[chain[-1]]))
        for i in reversed(chain):
            if i in known:
                continue
            last = int(after[i]) == len(x)
            until = end if last else int(at[after[i]]) - 1
            flat = range(int(at[i]) + patience, until + 1, patience)
            drops = tuple((p, float(x[i])) for p in flat[:limit])
            if last:
                known[i] = (float(x[i]), flat[-1] if flat else int(at[i]), drops)
            else:
                best, origin, more = known[int(after[i])]
                known[i] = (best, origin, (drops + more)[:limit] if drops else more)
    return [
        {"position": int(at[i]), "loss": float(x[i]), "best": known[i][0], "origin": known[i][1],
         "drops": [{"position": p, "best": v} for p, v in known[i][2]]}
        for i in range(near)
    ]


class _Fold:
    """Best loss and plateaus (position, best loss then) of one run, from the outcomes of its blocks in order."""

    def __init__(self, patience: int, min_delta: float, limit: int):
        self.patience, self.min_delta, self.limit = patience, min_delta, limit
        self.best, self.origin, self.drops = float("inf"), 0, []

    def take(self, last: int, outcomes: Sequence[dict]) -> None:
        """The next block, which ends at ``last``."""
        if len(self.drops) == self.limit:
            return
        entry = next((o for o in outcomes if o["loss"] < self.best - self.min_delta), None)
        until = last if entry is None else entry["position"] - 1
        for p in range(self.origin + self.patience, until + 1, self.patience):
            self.drops.append((p, self.best))
            self.origin = p
            if len(self.drops) == self.limit:
                return
        if entry is not None:
            self.drops += [(d["position"], d["best"]) for d in entry["drops"]][: self.limit - len(self.drops)]
            self.best, self.origin = entry["best"], entry["origin"]
            if len(self.drops) == self.limit:
                self.best = self.drops[-1][1]


def _block_starts(rows: pd.DataFrame, run: str, before: pd.DataFrame | None = None) -> np.ndarray:
    """Where rows do not go on the block of the row before them; ``before`` is the last row of the batch before."""
    at = rows if before is None else pd.concat([before, rows])
    name, block, position = (at[c].to_numpy() for c in (run, "_block", "position"))
    new = np.flatnonzero((name[1:] != name[:-1]) | (block[1:] != block[:-1]) | (position[1:] != position[:-1] + 1))
    return np.append(0, new + 1) if before is None else new


def plateaus(placed: DataFrame, run: str, loss: str, patience: int, min_delta: float, limit: int) -> DataFrame:
    """(run, best, drops) of runs of any length, in a fixed number of jobs.

    ``placed`` has positions and blocks of consecutive ones, in order of the runs wherever its files were cut. Blocks are
    summed up side by side where they lie, those of a task from one stream of rows, a block that files cut as several; a
    summary holds at most ``_zone(patience, limit)`` outcomes, as an improvement later in the block comes after the last
    plateau that matters. Only summaries are dealt to their runs, and folded as they come. Only the first ``limit``
    plateaus count. Rows in another order give the same result from more summaries.
    """
    field = placed.schema[run].dataType
    kind = field.simpleString()
    zone = _zone(patience, limit)

    def summaries(rows: pd.DataFrame) -> pd.DataFrame:
        starts = _block_starts(rows, mark)
        position, losses = rows["position"].to_numpy(np.int64), rows[loss].to_numpy(np.float64)
        ends = [*starts[1:], len(rows)]
        found = [_block_outcomes(position[a:b], losses[a:b], patience, min_delta, zone, limit) for a, b in zip(starts, ends)]
        return pd.DataFrame({
            run: rows[run].iloc[starts].reset_index(drop=True), "first": position[starts], "last": position[np.array(ends) - 1],
            "outcomes": found,
        })

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []  # the rows so far of the block that a batch may have cut
        for rows in batches:
            if not len(rows):
                continue
            starts = _block_starts(rows, mark, kept[-1].iloc[-1:] if kept else None)
            if not len(starts):
                kept.append(rows)
                continue
            whole = pd.concat([*kept, rows.iloc[:starts[-1]]], ignore_index=True)
            kept = [rows.iloc[starts[-1]:]]
            if len(whole):
                yield summaries(whole)
        if kept:
            yield summaries(pd.concat(kept, ignore_index=True))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        going: list[tuple] = []  # runs with their folds; the last one may go on
        for rows in batches:
            for value, first, last, outcomes in zip(rows[run], rows["first"], rows["last"], rows["outcomes"]):
                if first == 1:
                    going.append((value, _Fold(patience, min_delta, limit)))
                going[-1][1].take(last, outcomes)
            if len(going) > 1:
                yield folded(going[:-1])
                going = going[-1:]
        if going:
            yield folded(going)

    def folded(done: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({
            run: [value for value, _ in done], "best": [float(f.best) for _, f in done],
            "drops": [[{"position": int(p), "best": float(v)} for p, v in f.drops] for _, f in done],
        })

    drop = "array<struct<position: bigint, best: double>>"
    outcome = f"array<struct<position: bigint, loss: double, best: double, origin: bigint, drops: {drop}>>"
    # -0.0 and 0.0 are one run
    name = (F.col(run) + F.lit(0.0)).cast(field).alias(run) if isinstance(field, (T.FloatType, T.DoubleType)) else F.col(run)
    # Python tells whole numbers and strings apart as they are, others (NaN, nested values) by their JSON
    plain = isinstance(field, (T.IntegralType, T.StringType))
    mark = run if plain else "_run"
    marks = [] if plain else [F.to_json(F.struct(name)).alias(mark)]
    slim = placed.select(name, *marks, "_block", "position", F.col(loss).cast("double").alias(loss))
    summed = slim.mapInPandas(sum_up, f"`{run}` {kind}, first bigint, last bigint, outcomes {outcome}")
    return summed.repartition(run).sortWithinPartitions(run, "first").mapInPandas(fold, f"`{run}` {kind}, best double, drops {drop}")


def early_stop(
    df: DataFrame, run: str, epoch: str, loss: str, patience: int = 10, min_delta: float = 1e-4,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per run: best loss and the epoch at which training stops (NULL if it never does).

    A loss improves when it is below ``best - min_delta``; ``patience`` epochs in a row
    without improvement stop the run and later epochs do not count.
    """
    slim = _slim(df, run, epoch, loss)
    kind = slim.schema[epoch].dataType
    initial = F.struct(
        F.lit(float("inf")).alias("best"), F.lit(0).alias("wait"), F.lit(None).cast(kind).alias("stopped")
    )

    def step(s: Column, r: Column) -> Column:
        better = F.coalesce(r["loss"] < s["best"] - F.lit(min_delta), F.lit(False))
        wait = s["wait"] + 1
        return (
            F.when(s["stopped"].isNotNull(), s)
            .when(better, F.struct(r["loss"].alias("best"), F.lit(0).alias("wait"), s["stopped"].alias("stopped")))
            .otherwise(F.struct(
                s["best"].alias("best"), wait.alias("wait"),
                F.when(wait >= F.lit(patience), r["epoch"]).alias("stopped"),
            ))
        )

    sizes = group_sizes(slim, [run])
    if sizes[0] <= block_rows:
        packed = _packed(slim, run, epoch, loss)
        states = packed.select(run, F.aggregate("_rows", initial, step).alias("_state"))
    else:
        placed = _placed(slim, run, epoch, loss, max(block_rows, _zone(patience, 1)), sizes)
        found = plateaus(placed, run, loss, patience, min_delta, 1)
        found = found.select(run, "best", F.get("drops", F.lit(0))["position"].alias("position"))
        stops = placed.select(F.col(run).alias("_run"), "position", F.col(epoch).alias("_stopped"))
        same = (F.col(run) == F.col("_run")) & (found["position"] == stops["position"])
        states = found.join(stops, same, "left").select(run, F.struct("best", F.col("_stopped").alias("stopped")).alias("_state"))
    best = F.col("_state.best")
    return states.select(
        run, F.when(best < F.lit(float("inf")), best).alias("best_loss"), F.col("_state.stopped").alias("stopped_epoch")
    )


def _rate_after(drops: Column, position: Column, rates: Sequence[float]) -> Column:
    """The rate after the drops (ascending positions) at or before ``position``; a few are spelled out for generated code."""
    if len(rates) > SPELLED_OUT:
        return F.get(F.array(*[F.lit(r) for r in rates]), F.size(F.filter(drops, lambda d: d <= position)))
    rate = F.when(drops.isNotNull(), F.lit(rates[0]))
    for i, lower in enumerate(rates[1:]):
        rate = F.when(F.get(drops, F.lit(i)) <= position, F.lit(lower)).otherwise(rate)
    return rate


def lr_schedule(
    df: DataFrame, run: str, epoch: str, loss: str, initial_lr: float = 1e-3, factor: float = 0.5,
    patience: int = 5, min_lr: float = 1e-6, min_delta: float = 1e-4, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Learning rate after each epoch: halved (down to ``min_lr``) on every plateau.

    Only the drops are kept; a run is settled once its rate is at the
    floor. Each epoch then takes the rate of the last drop at or before it.
    """
    if not 0 <= factor < 1:
        raise ValueError("factor must be at least 0 and below 1")
    slim = _slim(df, run, epoch, loss)
    drop = F.struct(F.lit(0).cast("long").alias("position"), F.lit(float(initial_lr)).alias("lr"))
    initial = F.struct(
        F.lit(float("inf")).alias("best"), F.lit(0).alias("wait"), F.lit(float(initial_lr)).alias("lr"),
        F.array(drop).alias("drops"),
    )

    def step(s: Column, r: Column) -> Column:
        better = F.coalesce(r["loss"] < s["best"] - F.lit(min_delta), F.lit(False))
        wait = s["wait"] + 1
        lower = F.greatest(s["lr"] * F.lit(factor), F.lit(float(min_lr)))
        plateau = wait >= F.lit(patience)
        return (
            F.when(s["lr"] <= F.lit(float(min_lr)), s)
            .when(better, F.struct(r["loss"].alias("best"), F.lit(0).alias("wait"), s["lr"].alias("lr"), s["drops"].alias("drops")))
            .when(plateau, F.struct(
                s["best"].alias("best"), F.lit(0).alias("wait"), lower.alias("lr"),
                F.concat(s["drops"], F.array(F.struct(r["position"].cast("long").alias("position"), lower.alias("lr")))).alias("drops"),
            ))
            .otherwise(F.struct(s["best"].alias("best"), wait.alias("wait"), s["lr"].alias("lr"), s["drops"].alias("drops")))
        )

    def rate_at(drops: Column, position: Column) -> Column:
        return F.element_at(F.filter(drops, lambda d: d["position"] <= position), -1)["lr"]

    sizes = group_sizes(slim, [run])
    if sizes[0] <= block_rows:
        folded = _packed(slim, run, epoch, loss).withColumn("_drops", F.aggregate("_rows", initial, step)["drops"])
        rates = F.transform("_rows", lambda r: F.struct(
            r["epoch"].alias(epoch), rate_at(F.col("_drops"), r["position"]).alias("lr")))
        return folded.select(run, F.inline(rates))
    rates = [float(initial_lr)]
    while rates[-1] > min_lr and max(rates[-1] * factor, min_lr) < rates[-1]:
        rates.append(max(rates[-1] * factor, float(min_lr)))
    placed = _placed(slim, run, epoch, loss, max(block_rows, _zone(patience, len(rates) - 1)), sizes)
    found = plateaus(placed, run, loss, patience, min_delta, len(rates) - 1)
    joined = join_lookup(placed, found.select(run, F.transform("drops", lambda d: d["position"]).alias("_drops")), [run])
    return joined.select(run, epoch, _rate_after(F.col("_drops"), F.col("position"), rates).alias("lr"))


def best_checkpoints(df: DataFrame, run: str, epoch: str, loss: str, keep: int = 3) -> DataFrame:
    """The ``keep`` rows of least loss per run. Spark limits each group before the shuffle."""
    value = number(df, loss)
    order = Window.partitionBy(run).orderBy(value.asc_nulls_last(), F.col(epoch))
    return df.filter(value.isNotNull()).select(
        run, epoch, value.alias(loss), F.row_number().over(order).alias("rank")
    ).filter(F.col("rank") <= keep)


def run_series(spark: SparkSession, configs: Sequence[dict], run: Callable[[dict], object]) -> DataFrame:
    """Run a list of configurations; a failed one becomes an error row and the rest go on."""
    rows = []
    for i, config in enumerate(configs):
        try:
            rows.append((i, "success", str(run(config)), None))
        except Exception as e:  # noqa: BLE001 - the failure is the result
            rows.append((i, "error", None, "".join(traceback.format_exception_only(e)).strip()))
    return spark.createDataFrame(rows, "run int, status string, result string, error string")
