"""Aggregate expressions that are computed together in one pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moments(x: Column, population: bool = False) -> dict[str, Column]:
    return {
        "mean": F.avg(x),
        "std": F.stddev_pop(x) if population else F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
        "count": F.count(x),
    }


def regression_scores(actual: Column, predicted: Column) -> dict[str, Column]:
    """mse, rmse, mae and r2 over the rows where both values are there."""
    error = actual - predicted
    seen = F.when(error.isNotNull(), actual)
    mse = F.avg(error * error)
    return {
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(error)),
        "r2": F.lit(1.0) - F.try_divide(F.sum(error * error), F.count(error) * F.var_pop(seen)),
    }
