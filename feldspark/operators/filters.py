"""Configured row filters, named expressions and the ordered model input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspark.functions.missing import is_float, is_missing, number


def condition(df: DataFrame, column: str, text: str) -> Column | None:
    """``not_null``, ``gt:<number>`` or ``lt:<number>``; anything else is None.

    The comparison stays on the bare column, so it reaches the parquet scan; the NaN
    test (Spark orders NaN above all numbers) is a second conjunct.
    """
    c = F.col(f"`{column}`")
    real = ~F.isnan(c) if is_float(df, column) else None
    kind, _, value = text.partition(":")
    if text == "not_null":
        test = c.isNotNull()
    elif kind == "gt":
        test = c > F.lit(float(value))
    elif kind == "lt":
        return c < F.lit(float(value))
    else:
        return None
    return test if real is None else test & real


def apply_steps(df: DataFrame, steps: Sequence[dict]) -> DataFrame:
    """Apply configured steps in list order.

    ``{"type": "filter", "column": c, "condition": text}`` keeps rows; unknown
    conditions are ignored. ``{"type": "map", "name": n, "expr": sql}`` adds a column.
    """
    for step in steps:
        if step["type"] == "filter":
            test = condition(df, step["column"], step["condition"])
            df = df if test is None else df.filter(test)
        elif step["type"] == "map":
            df = df.withColumn(step["name"], F.expr(step["expr"]))
        else:
            raise ValueError(f"Unknown step type: {step['type']}")
    return df


def model_input(
    df: DataFrame, expected: Sequence[str], keep: Sequence[str] = (), on_missing: str = "error"
) -> DataFrame:
    """The expected features in order: ``f`` where given, else ``f`` without ``_norm``.

    A feature that neither column can supply is an error, or with
    ``on_missing="flag"`` a false ``valid``.
    """
    chosen: list[Column] = []
    complete: Column = F.lit(True)
    for name in expected:
        plain = name.removesuffix("_norm")
        found = [n for n in dict.fromkeys((name, plain)) if n in df.columns]
        if not found:
            raise ValueError(f"Missing feature: {name}")
        value = F.coalesce(*[number(df, n) for n in found])
        if on_missing == "error":
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"Missing feature: {name}")).cast("double")
            )
        else:
            complete = complete & value.isNotNull()
        chosen.append(value.alias(name))
    flag = [complete.alias("valid")] if on_missing == "flag" else []
    return df.select(*keep, *chosen, *flag)


def missing_counts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.count_if(is_missing(df, c)).alias(c) for c in columns]
