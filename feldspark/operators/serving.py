"""Batch serving: stored-statistics transforms, scoring and prediction logs."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.functions.expressions import linear_score
from feldspark.functions.missing import number


def transform_records(df: DataFrame, stats: dict[str, dict[str, float]], interaction: bool = True) -> DataFrame:
    """Standardize the base feature of every stored statistic as ``<base>_norm``.

    A stored deviation of zero gives 0.0. The interaction of the first two normalized
    features is added where both are there; unusable statistics leave the records as they are.
    """
    added: dict[str, Column] = {}
    for name, known in stats.items():
        base = name.removesuffix("_norm")
        if base not in df.columns:
            continue
        x = number(df, base)
        if (known.get("std") or 0.0) > 0:
            if known.get("mean") is None:
                return df
            added[f"{base}_norm"] = (x - F.lit(known["mean"])) / F.lit(known["std"])
        else:
            added[f"{base}_norm"] = F.when(x.isNotNull(), F.lit(0.0))
    df = df.withColumns(added) if added else df
    if interaction and {"feature_1_norm", "feature_2_norm"} <= set(df.columns):
        df = df.withColumn("feature_interaction", F.col("feature_1_norm") * F.col("feature_2_norm"))
    return df


def stats_of(rows: DataFrame) -> dict[str, dict[str, float]]:
    """A statistics table (one row per feature) as the dictionary the transforms take."""
    return {r["feature"]: {k: v for k, v in r.asDict().items() if k != "feature"} for r in rows.collect()}


def save_stats(
    spark: SparkSession, path: str, stats: dict[str, dict[str, float]], name: str, description: str = ""
) -> None:
    """Append one named set of statistics to the statistics table."""
    entry = {
        "name": name,
        "description": description,
        "created_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        "num_features": len(stats),
        "stats": stats,
    }
    spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1).write.mode("append").text(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    """All saved statistics, one row per set and feature."""
    schema = (
        "name string, description string, created_at string, num_features long, "
        "stats map<string, struct<mean: double, std: double, min: double, max: double, count: long>>"
    )
    rows = spark.read.schema(schema).json(path)
    return rows.select("name", "description", "created_at", "num_features",
                       F.explode("stats").alias("feature", "s")).select(
        "name", "description", "created_at", "num_features", "feature", "s.*"
    )


def score_linear(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], intercept: float, output: str = "prediction"
) -> DataFrame:
    """Score every row with a linear model, as one JVM expression."""
    return df.withColumn(output, linear_score([number(df, f) for f in features], weights, intercept))


def prediction_log(
    scored: DataFrame, key: str, version: str, batch: str, prediction: str = "prediction",
    features: Sequence[str] = (),
) -> DataFrame:
    """Log rows for a scored batch.

    The id is derived from batch and row key, so a retried task logs the same ids.
    """
    digest = F.md5(F.concat_ws(":", F.lit(batch), F.col(key).cast("string")))
    ident = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    extra = [F.struct(*features).alias("features")] if features else []
    return scored.select(
        ident.alias("prediction_id"), F.lit(batch).alias("batch_id"), F.col(key), F.col(prediction),
        F.lit(version).alias("model_version"), F.current_timestamp().alias("timestamp"), *extra,
    )


def batch_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("batch_id", "model_version").agg(F.count(F.lit(1)).alias("count"))


def latest_versions(registry: DataFrame, model: str = "model", version: str = "version") -> DataFrame:
    """Newest version per model: the greatest number, or the greatest name if none is a number."""
    numeric = F.expr(f"try_cast(`{version}` AS bigint)")
    return registry.groupBy(model).agg(
        F.coalesce(F.max_by(version, numeric), F.max(version)).alias("latest_version")
    )
