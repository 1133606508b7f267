"""Metric analysis: recency, loss spikes, drift, decay, threshold alerts and summaries.

A metric table has ``seq`` (append order, unique), ``name``, ``value``, ``ts`` and
optionally ``context``.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from feldspark.functions.expressions import kolmogorov_pvalue
from feldspark.functions.missing import number
from feldspark.operators.ordering import (
    CHUNK_ROWS, cut_points, group_sizes, in_blocks, rank_within, with_bucket,
)
from feldspark.session import materialize

# The p-value function travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Metric names, limits, alert types and message texts.
THRESHOLDS = (
    ("system.cpu.percent", 80.0, "high_cpu_usage", "High CPU usage: %.1f%%"),
    ("system.memory.percent", 90.0, "high_memory_usage", "High memory usage: %.1f%%"),
    ("serving.prediction.latency", 1.0, "high_prediction_latency", "High prediction latency: %.3fs"),
)
SPIKE_TEXT = "Training loss spike in %s: %.4f (5x previous average)"
DRIFT_TEXT = "Data drift detected in feature %s: KS statistic = %.4f, p-value = %.4f"
DECAY_TEXT = "Model %s performance decay in %s: %.1f%% decay"
DRIFT_ALPHA = 0.05
EXACT_ROWS = 10_000  # samples up to this size get an exact p-value
DECAY_LIMIT = 0.1
SPIKE_FACTOR = 5.0


def recent_metrics(metrics: DataFrame, n: int = 100, buffer: int | None = None) -> DataFrame:
    """The ``n`` newest metrics (a top-n, no sort of the table), at most ``buffer`` of them if one is given."""
    return metrics.orderBy(F.desc("ts"), F.desc("seq")).limit(n if buffer is None else min(n, buffer))


def loss_spikes(
    metrics: DataFrame, context: str = "context", window: int = 10, factor: float = SPIKE_FACTOR,
    chunk_rows: int = CHUNK_ROWS, sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Losses above ``factor`` times the mean of up to ``window - 1`` losses before them.

    If some context is too large for one task, contexts are cut into blocks of consecutive
    positions that repeat the last rows of the block before, so that the sliding window of
    a hot context runs in many tasks.
    """
    slim = metrics.select("seq", context, "ts", number(metrics, "value").alias("value"))
    sizes = sizes or group_sizes(slim, [context])  # rows of the largest context and of all, or bounds of them
    if sizes[0] <= chunk_rows:
        past = Window.partitionBy(context).orderBy("ts", "seq").rowsBetween(1 - window, -1)
        seen = slim.withColumn("previous", F.avg("value").over(past))
    else:
        placed = rank_within(slim, [context], ["ts", "seq"], chunk_rows=chunk_rows, sizes=sizes)
        blocks = in_blocks(placed, "position", max(chunk_rows, window), halo=window - 1)
        past = Window.partitionBy(context, "_block").orderBy("position").rowsBetween(1 - window, -1)
        seen = blocks.withColumn("previous", F.avg("value").over(past)).filter("_own")
    return seen.filter(
        (F.col("previous") > 0) & (F.col("value") > F.col("previous") * F.lit(factor))
    ).select("seq", context, "ts", "value", "previous")


def ks_drift(
    reference: DataFrame, current: DataFrame, features: Sequence[str],
    alpha: float = DRIFT_ALPHA, chunk_rows: int = CHUNK_ROWS, min_chunks: int = 200, exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per feature: statistic, p-value, decision.

    Sketched cut points part each feature into ordered chunks, and one counting pass
    gives the distribution gap at every chunk end. Inside a chunk the gap cannot grow
    by more than the shares the chunk holds, so only chunks that may hide a larger gap
    are looked at value by value; only their rows are shuffled, counted per distinct
    value first. No feature is sorted in one task. A feature without a value on one side
    has a row of NULLs. The p-value is exact for samples of up to ``exact_rows`` values and asymptotic beyond.
    """
    both = _one_side(reference, features, 0).unionByName(_one_side(current, features, 1))
    total = both.count()
    chunks = max(min_chunks, -(-total // chunk_rows))
    names = [f"x{i}" for i in range(len(features))]
    cuts = cut_points(both, {n: F.col(n) for n in names}, total, chunks)
    staged = both
    for i in range(len(features)):
        staged = with_bucket(staged, f"x{i}", cuts[f"x{i}"], f"c{i}")
    tall = staged.select("_side", F.inline(F.array(*[
        F.struct(F.lit(i).alias("f"), F.col(f"c{i}").alias("chunk"), F.col(f"x{i}").alias("x"))
        for i in range(len(features))
    ]))).filter(F.col("x").isNotNull())
    one = [F.count_if(F.col("_side") == 0).alias("a"), F.count_if(F.col("_side") == 1).alias("b")]
    # at most one row per feature and chunk, summed up in order of the chunks of a feature
    counted = materialize(tall.groupBy("f", "chunk").agg(*one), "chunks")
    of_feature = Window.partitionBy("f")
    so_far = of_feature.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    shares = counted.withColumns({
        "n": F.sum("a").over(of_feature), "m": F.sum("b").over(of_feature),
        "a1": F.sum("a").over(so_far), "b1": F.sum("b").over(so_far),
    }).filter("n > 0 AND m > 0").withColumns({"a0": F.col("a1") - F.col("a"), "b0": F.col("b1") - F.col("b")})
    gap_of = lambda a, b: F.abs(F.col(a) / F.col("n") - F.col(b) / F.col("m"))
    bounded = shares.withColumns({
        "at_ends": F.max(gap_of("a1", "b1")).over(of_feature), "bound": F.greatest(gap_of("a1", "b0"), gap_of("a0", "b1")),
    })
    spark = reference.sparkSession
    asked = spark.createDataFrame(list(enumerate(features)), "f int, feature string")
    known = materialize(
        asked.join(bounded.select("f", "n", "m", "at_ends").distinct(), "f", "left"), "features"
    )
    open_ = bounded.filter(F.col("bound") > F.col("at_ends")).select("f", "chunk", "a0", "b0")
    values = tall.join(open_, ["f", "chunk"]).groupBy("f", "chunk", "a0", "b0", "x").agg(*one)
    inside = Window.partitionBy("f", "chunk", "a0", "b0").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    running = values.select(
        "f", (F.col("a0") + F.sum("a").over(inside)).alias("ra"), (F.col("b0") + F.sum("b").over(inside)).alias("rb")
    )
    gap = F.max(F.abs(F.col("ra") / F.col("n") - F.col("rb") / F.col("m"))).alias("within")
    within = running.join(F.broadcast(known), "f").groupBy("f").agg(gap)
    tests = known.join(within, "f", "left").withColumn(
        "ks_statistic", F.greatest("at_ends", "within")
    )
    few = F.greatest("n", "m") <= F.lit(exact_rows)
    place = lambda c: F.when(few, F.col(c))
    exact = _exact_pvalue()(place("ks_statistic"), place("n"), place("m"))
    p = F.when(F.col("ks_statistic").isNotNull(), F.coalesce(exact, kolmogorov_pvalue(F.col("ks_statistic"), F.col("n"), F.col("m"))))
    return tests.select("feature", "ks_statistic", p.alias("ks_pvalue")).withColumn(
        "drift_detected", F.col("ks_pvalue") < F.lit(alpha)
    )


def ks_exact(gap: float, n: int, m: int) -> float:
    """Probability that samples of ``n`` and ``m`` from one distribution differ by ``gap`` or more.

    Merging two samples is a random path over the lattice of (values of the first, values of the second) taken so far;
    the test statistic stays below ``gap`` if the path stays inside a band. The share of paths inside is carried from
    one diagonal to the next: at (i, j) the last step came from the first sample with probability i / (i + j).
    """
    limit = round(gap * n * m)  # gaps are multiples of 1 / (n m)
    i = np.arange(n + 1)
    inside = np.zeros(n + 1)
    inside[0] = 1.0 if limit > 0 else 0.0
    for s in range(1, n + m + 1):
        before = np.concatenate([[0.0], inside[:-1]])
        inside = (i / s) * before + ((s - i) / s) * inside
        inside[(i > s) | (s - i > m) | (np.abs(i * m - (s - i) * n) >= limit)] = 0.0
    return float(min(max(1.0 - inside[n], 0.0), 1.0))


def _exact_pvalue():
    one = ks_exact

    @pandas_udf("double")
    def value(gap: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(g) else one(g, int(a), int(b)) for g, a, b in zip(gap, n, m)], dtype="float64")

    return value


def _one_side(sample: DataFrame, features: Sequence[str], side: int) -> DataFrame:
    """The features as doubles x0, x1, ... (-0.0 and 0.0 are one value) and the side."""
    values = [(number(sample, f) + F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)]
    return sample.select(*values, F.lit(side).alias("_side"))


def metric_decay(
    current: DataFrame, reference: DataFrame, name: str = "name", value: str = "value", limit: float = DECAY_LIMIT
) -> DataFrame:
    """Relative change of each metric both sides have, where the reference is not zero.

    A name that repeats counts by its newest row (the greatest ``seq``, or else the greatest value).
    """

    def one_each(df: DataFrame, output: str) -> DataFrame:
        x = number(df, value)
        return df.groupBy(name).agg((F.max_by(x, F.col("seq")) if "seq" in df.columns else F.max(x)).alias(output))

    new, old = one_each(current, "current_value"), one_each(reference, "reference_value")
    both = new.join(old, name).filter(F.col("reference_value") != 0)
    ratio = F.abs(F.col("current_value") - F.col("reference_value")) / F.abs("reference_value")
    return both.withColumn("decay", ratio).withColumn("decayed", F.col("decay") > F.lit(limit))


def _threshold_columns(thresholds: Sequence[tuple]) -> tuple[Column, Column, Column]:
    """(over the limit, alert type, message) as expressions; the table of limits is a short constant."""
    name, value = F.col("name"), F.col("value")
    over, kind, text = F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string")
    for metric, limit, alert, message in thresholds:
        mine = name == metric
        over = F.when(mine, ~F.isnan(value) & (value > F.lit(float(limit)))).otherwise(over)
        kind = F.when(mine, F.lit(alert)).otherwise(kind)
        text = F.when(mine, F.format_string(message, value)).otherwise(text)
    return over, kind, text


def exceeding(metrics: DataFrame, thresholds: Sequence[tuple] = THRESHOLDS) -> DataFrame:
    """All metrics over their limit, as alerts. Narrow, so it also runs on a stream."""
    over, kind, text = _threshold_columns(thresholds)
    return metrics.filter(over).select(
        "seq", "name", "value", "ts", kind.alias("type"), text.alias("message"), F.lit("warning").alias("severity")
    )


def threshold_alerts(metrics: DataFrame, thresholds: Sequence[tuple] = THRESHOLDS, recent: int = 100) -> DataFrame:
    """Threshold alerts among the most recent metrics."""
    return exceeding(recent_metrics(metrics, recent), thresholds)


def metric_summary(metrics: DataFrame, prefix: str = "system.", recent: int = 100) -> DataFrame:
    """Average and maximum per metric name with ``prefix`` among the most recent metrics."""
    newest = recent_metrics(metrics, recent).filter(F.col("name").startswith(prefix))
    value = number(newest, "value")
    return newest.groupBy("name").agg(
        F.avg(value).alias("avg"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n")
    )


def monitor_counts(metrics: DataFrame, alerts: DataFrame, recent: int = 100, buffer: int | None = None) -> DataFrame:
    """One row: metrics (of the newest ``buffer``, if one is given), recent metrics, alerts."""
    total = F.count(F.lit(1))
    held = metrics.agg(
        (total if buffer is None else F.least(total, F.lit(buffer))).alias("total_metrics"),
        F.least(F.count(F.lit(1)), F.lit(recent)).alias("recent_metrics_count"),
        F.lit(0).cast("long").alias("active_alerts"),
    )
    raised = alerts.agg(
        F.lit(0).cast("long").alias("total_metrics"), F.lit(0).cast("long").alias("recent_metrics_count"),
        F.count(F.lit(1)).alias("active_alerts"),
    )
    both = held.unionByName(raised)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    return alerts.orderBy(F.desc("timestamp"), F.desc("message")).limit(n)


def as_alerts(rows: DataFrame, kind: str, message: Column, tags: dict[str, Column], severity: str = "warning") -> DataFrame:
    """Alert rows (type, message, severity, timestamp, tags) for the findings in ``rows``."""
    pairs = [x for k, v in tags.items() for x in (F.lit(k), v.cast("string"))]
    labels = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return rows.select(
        F.lit(kind).alias("type"), message.alias("message"), F.lit(severity).alias("severity"),
        F.current_timestamp().alias("timestamp"), labels.alias("tags"),
    )


def spike_alerts(spikes: DataFrame, context: str = "context") -> DataFrame:
    text = F.format_string(SPIKE_TEXT, F.col(context).cast("string"), F.col("value"))
    return as_alerts(spikes, "training_loss_spike", text, {"context": F.col(context)})


def drift_alerts(tests: DataFrame) -> DataFrame:
    text = F.format_string(DRIFT_TEXT, F.col("feature"), F.col("ks_statistic"), F.col("ks_pvalue"))
    return as_alerts(tests.filter("drift_detected"), "data_drift", text, {"feature": F.col("feature")})


def decay_alerts(decay: DataFrame, version: str, name: str = "name") -> DataFrame:
    text = F.format_string(DECAY_TEXT, F.lit(version), F.col(name), F.col("decay") * 100.0)
    tags = {"model_version": F.lit(version), "metric": F.col(name)}
    return as_alerts(decay.filter("decayed"), "model_decay", text, tags)


def limit_alerts(exceeded: DataFrame) -> DataFrame:
    return exceeded.select(
        "type", "message", "severity", F.current_timestamp().alias("timestamp"),
        F.create_map().cast("map<string,string>").alias("tags"),
    )


def all_alerts(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class MetricLog:
    """Append-only tables of metrics and alerts below ``base``."""

    spark: SparkSession
    base: str

    def record(self, metrics: DataFrame) -> None:
        metrics.write.mode("append").parquet(f"{self.base}/metrics")

    def raise_alerts(self, alerts: DataFrame) -> None:
        alerts.write.mode("append").parquet(f"{self.base}/alerts")

    def metrics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/metrics")

    def alerts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/alerts")
