"""Column, record, metric and epoch statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspark.functions.aggregates import moments, regression_scores
from feldspark.functions.missing import is_missing, number, numeric_columns


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns named like features: ``feature_*`` or ``*_norm``."""
    return [c for c in numeric_columns(df) if c.startswith("feature_") or c.endswith("_norm")]


def stat_expressions(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """``{column|stat: aggregate}`` for one pass over all columns, also usable in ``observe``."""
    found: dict[str, Column] = {}
    for name in columns:
        for stat, expr in moments(number(df, name)).items():
            found[f"{name}|{stat}"] = expr
        found[f"{name}|null_count"] = F.count_if(is_missing(df, name))
    return found


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: mean, sample std, min, max, count, null_count."""
    names = list(columns) if columns is not None else feature_columns(df)
    wide = df.agg(*[e.alias(k) for k, e in stat_expressions(df, names).items()])
    rows = [
        F.struct(F.lit(n).alias("feature"), *[
            F.col(f"`{n}|{s}`").alias(s) for s in ("mean", "std", "min", "max", "count", "null_count")
        ])
        for n in names
    ]
    return wide.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, all in one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_count"), F.col("_n").alias("num_rows"))
        for c in df.columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def record_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Statistics of records held as columns (NULL = absent key), with population std."""
    names = list(columns) if columns is not None else numeric_columns(df)
    wide = df.agg(*[
        F.struct(F.lit(n).alias("feature"), *[
            e.alias(s) for s, e in moments(number(df, n), population=True).items()
        ]).alias(n)
        for n in names
    ])
    return wide.select(F.inline(F.array(*[F.col(f"`{n}`") for n in names]))).filter(F.col("count") > 0)


def record_stats_map(df: DataFrame, record: str) -> DataFrame:
    """The same for records held as one ``map<string,double>`` column."""
    flat = df.select(F.explode(record).alias("feature", "_raw"))
    value = F.when(~F.isnan("_raw"), F.col("_raw"))
    stats = flat.groupBy("feature").agg(*[e.alias(s) for s, e in moments(value, population=True).items()])
    return stats.filter(F.col("count") > 0)


def regression_metrics(df: DataFrame, actual: str, predicted: str, prefix: str = "") -> DataFrame:
    scores = regression_scores(number(df, actual), number(df, predicted))
    return df.agg(*[e.alias(f"{prefix}{n}") for n, e in scores.items()])


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def epoch_loss(df: DataFrame, epoch: str, batch: str, loss: str) -> DataFrame:
    """Per epoch the mean of batch means, and the mean over rows beside it."""
    value = number(df, loss)
    batches = df.groupBy(epoch, batch).agg(
        F.avg(value).alias("_mean"), F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )
    return batches.groupBy(epoch).agg(
        F.avg("_mean").alias("loss"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("row_loss"),
        F.count(F.lit(1)).alias("num_batches"),
    )
