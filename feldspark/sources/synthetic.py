"""Synthetic tables. Every value is a function of (seed, id), so any task can rebuild any row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.functions.hashing import driver_normal, normal, uniform


def coefficients(seed: int, count: int) -> list[float]:
    return [driver_normal(seed, "coefficient", i) for i in range(1, count + 1)]


def _features(ids: DataFrame, count: int, seed: int) -> DataFrame:
    return ids.select("id", *[normal(seed, F.lit(f"x{i}"), F.col("id")).alias(f"feature_{i}")
                              for i in range(1, count + 1)])


def _linear(weights: Sequence[float], seed: int) -> Column:
    total = 0.1 * normal(seed, F.lit("noise"), F.col("id"))
    for i, w in enumerate(weights, 1):
        total = total + F.col(f"feature_{i}") * F.lit(w)
    return total


def regression_rows(ids: DataFrame, num_features: int = 4, seed: int = 42) -> DataFrame:
    """Normal features and an integer target ``trunc(X·w + 0.1·noise)`` for each ``id``."""
    rows = _features(ids, num_features, seed)
    return rows.withColumn("target", _linear(coefficients(seed, num_features), seed).cast("long"))


def synthetic_regression(
    spark: SparkSession, num_samples: int = 10_000, num_features: int = 4, seed: int = 42
) -> DataFrame:
    return regression_rows(spark.range(num_samples), num_features, seed)


def check_synthetic(df: DataFrame, num_samples: int, num_features: int) -> bool:
    return len(df.columns) == num_features + 2 and df.count() == num_samples


def labelled_rows(ids: DataFrame, num_features: int = 4, seed: int = 42) -> DataFrame:
    """A binary target (above the mean of a partly nonlinear signal) and one row per minute."""
    if num_features < 3:
        raise ValueError("at least three features are needed")
    signal = (
        _linear(coefficients(seed, num_features), seed)
        + 0.5 * F.col("feature_1") * F.col("feature_2")
        + 0.3 * F.sin(F.col("feature_3") * 2.0)
    )
    rows = _features(ids, num_features, seed).withColumn("_y", signal)
    mean = rows.agg(F.avg("_y")).first()[0]
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return rows.select(
        "id", *[f"feature_{i}" for i in range(1, num_features + 1)],
        (F.col("_y") > F.lit(mean)).cast("long").alias("target"),
        (start + F.make_dt_interval(
            days=F.floor(F.col("id") / 1440).cast("int"), mins=F.pmod("id", F.lit(1440)).cast("int")
        )).alias("timestamp"),
    )


def synthetic_labelled(
    spark: SparkSession, num_rows: int = 100_000, num_features: int = 4, seed: int = 42
) -> DataFrame:
    return labelled_rows(spark.range(num_rows), num_features, seed)


def partitioned_rows(ids: DataFrame, partitions: int = 10) -> DataFrame:
    """A normal and a uniform feature and a 0/1 target, seeded per partition of the ids."""
    part = F.pmod("id", F.lit(partitions))
    return ids.select(
        normal("part", part, F.lit("normal"), F.col("id")).alias("feature_1"),
        uniform("part", part, F.lit("uniform"), F.col("id")).alias("feature_2"),
        (uniform("part", part, F.lit("target"), F.col("id")) >= 0.5).cast("long").alias("target"),
    )


def synthetic_partitioned(spark: SparkSession, rows: int = 1_000_000, partitions: int = 10) -> DataFrame:
    return partitioned_rows(spark.range(0, rows // partitions * partitions, 1, partitions), partitions)
